"""Source divergence against SQL, and against the definition on hard rows."""

import re
from collections import Counter
from itertools import permutations

import pandas as pd

from panelwise.llm import divergence
from panelwise.llm.common import pieces
from panelwise.llm.queries import ORACLES, QUERIES
from tests.llm.data import CLASHING, hard_documents, words
from tools.check_oracles import connect, difference

WORD = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def by_definition(rows, least=10, top=10):
    docs = [(lang or "", source or "", WORD.findall(lowered(text or ""))) for lang, source, text in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        spread = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in spread.items() if n >= least}
        counts = {s: Counter(t for d in mine if d[1] == s for t in d[2] if t in kept) for s in {d[1] for d in mine}}

        def shares(c, kept=kept):
            total = sum(c.values())
            return {t: 1 + 10**9 * (c[t] + 2) // (total + 2 * len(kept)) for t in kept}

        def f(p, q):
            return (p - q) ** 2 // (p + q)

        p, q = {s: shares(c) for s, c in counts.items()}, shares(sum(counts.values(), Counter()))
        found = {s: {"pair": [], "term": []} for s in counts}
        for a, b in permutations(counts, 2):
            found[a]["pair"].append((sum(f(p[a][t], p[b][t]) for t in kept), b))
        for s, c in counts.items():
            found[s]["term"] = [(f(p[s][t], q[t]), t) for t in kept if c[t] and p[s][t] > q[t]]
            for part, some in found[s].items():
                some.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i) for i, (value, item) in enumerate(some, 1) if part == "pair" or i <= top]
    return pd.DataFrame(out, columns=["lang", "source", "part", "item", "value", "rank"])


def frame(spark, rows):
    clash = CLASHING.replace("rank int", "rank int, p int, q int, z int, value int, term string, part string, h int")
    schema = f"lang string, source string, text string, {clash}"
    return spark.createDataFrame([(*r, *[None] * (schema.count(",") - 2)) for r in rows], schema).repartition(5)


def hard_rows():
    rows = [("de" if i % 3 else None, f"s{i % 4}" if i % 5 else None, text) for i, (_, text) in enumerate(hard_documents() * 3)]
    rows += [("en", f"é{i % 7}", f"Straße über STRASSE x{i % 3}y naïve\x00word K {words(i % 9, i % 4)}") for i in range(150)]
    rows += [("en", "hot", "same same Same other")] * 120 + [("en", "empty", None), ("xx", "one", "few words"), ("xx", "two", ""), ("yy", "alone", "a b c")]
    return rows + [("en", "long", words(20_000, 5) + " same" * 500_000)]


def test_divergence_equals_sql(spark, sf):
    got = QUERIES["op13_source_divergence"](spark, sf).toPandas()
    assert difference(got, connect(sf).execute(ORACLES["op13_source_divergence"]).df()) is None


def test_divergence_equals_its_definition_in_small_blocks_and_segments(spark):
    rows = hard_rows()
    want = by_definition(rows, 3, 4).astype({"rank": "int32"})
    for memory, segment in ((1 << 12, 7), (128 << 20, 4096)):
        got = divergence.source_divergence(frame(spark, rows), 3, 4, memory, segment).toPandas()
        assert difference(got, want) is None
    assert set(want.part) == {"pair", "term"} and (want[want.lang == "xx"].value == 0).all()


def test_divergence_of_an_empty_table(spark):
    assert divergence.source_divergence(frame(spark, [])).count() == 0


def test_shares_are_exact_for_large_counts(spark):
    rows = [(0, 0, 1), (10**15, 4 * 10**15, 3 * 10**9), (7 * 10**14 + 1, 8 * 10**15 + 3, 5), (999_999_999_999, 10**12, 1)]
    df = spark.createDataFrame(rows, "c long, n long, v long").withColumn("p", divergence.share("c", "n", "v"))
    assert [r.p for r in df.collect()] == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in rows]


def test_runs_are_merged_in_order():
    def segment(shard, lang, *terms):
        return divergence.Segment(shard, lang, [t for t, _ in terms], [n for _, n in terms], [], [], [])

    segments = [segment(0, "a", (b"a", 1), (b"x", 2)), segment(0, "a", (b"b", 3), (b"x", 4)), segment(0, "a", (b"x", 5)), segment(0, "b", (b"a", 6)), segment(1, "a", (b"a", 7))]
    got = [(lang, term, docs, len(parts)) for lang, term, docs, parts in divergence.in_order(segments)]
    assert got == [("a", b"a", 1, 1), ("a", b"b", 3, 1), ("a", b"x", 11, 3), ("b", b"a", 6, 1), ("a", b"a", 7, 1)]


def test_long_texts_are_split_between_terms():
    text = (b"ab " * 1000 + b"c" * 5000 + b" d") * 3
    parts = list(pieces(text, divergence.TERMS, 512))
    assert len(parts) > 10 and sum(parts, []) == text.translate(divergence.TERMS).split()
