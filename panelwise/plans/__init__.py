"""Whole plans: table bindings, feature chains and the query catalog."""
