"""Readers, JSON flattening, manifests and writers."""
