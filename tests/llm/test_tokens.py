import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from panelwise.llm import automaton, encoding, materialize, packing
from panelwise.llm.queries import BYTES, QUERIES, WORDS
from panelwise.llm.wordpieces import ChunkEncoder
from tests.llm.data import frame, hard_documents

ODD = [
    "  ", "a  b", " \n\n x", "x<|endoftext|>y <|endoftext|> ", "<|endoftext", "ab" * 3000 + "  ", "\x01\x01 a", "\t\tx\r\n y",
    "don't we'll I'M 12 345  \n", "🙂 🙂🙂", "　　字字", "a\x1c\x1cb", "\x85\x85a", "word.word,Word;", "é'é.", "a.\nb,\n c",
]


def test_bpe_round_trip_and_library(spark):
    rows = hard_documents() + [(100 + i, t) for i, t in enumerate(ODD)]
    t = Tokenizer.from_file(BYTES)
    got = encoding.digests(encoding.decoded(encoding.encoded(frame(spark, rows), BYTES, frequent=40), BYTES)).collect()
    want = []
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4")
        said = t.decode(ids.tolist(), skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(said.encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    once = encoding.digests(encoding.round_trip(frame(spark, rows), BYTES, frequent=40)).collect()
    assert sorted(map(tuple, once), key=repr) == sorted(want, key=repr)
    assert encoding.encoded(frame(spark, []), BYTES).count() == 0


def test_bpe_on_given_documents(spark, sf):
    t = Tokenizer.from_file(BYTES)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in QUERIES["op7_bpe_encoding_decoding"](spark, sf).collect():
        ids = np.array(t.encode(docs[r.doc_id], add_special_tokens=False).ids, "<u4")
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_transducer_is_minimal_and_exact(tmp_path):
    words = {b"tap": [1], b"taps": [2, 3], b"top": [4], b"tops": [5], b"x": [6, 7, 8]}
    automaton.save(automaton.compile_words(words), str(tmp_path / "a"))
    a = automaton.mapped(str(tmp_path / "a"))
    assert len(a["final"]) == 5  # start, t, ta = to, tap = top, end, which x shares
    found = automaton.numbers(a, [*words, b"", b"ta", b"tapz", b"y", b"tapss"])
    assert (found[len(words) :] == -1).all()
    for n, ids in zip(found, words.values(), strict=False):
        assert a["ids"][a["bounds"][n] : a["bounds"][n + 1]].tolist() == ids
    assert (automaton.numbers(automaton.compile_words({}), [b"a"]) == -1).all()


def test_merges_of_short_and_long_words_agree():
    m = encoding.Merges(BYTES)
    for w in (b"abcabcabcabc", b"aaaaaaaaaaaaaaa", "élève".encode(), b"the", b"\xff\xfe\x00"):
        ids, _ = m._together([w])
        assert ids.tolist() == m._alone(w)


def pieces_of(rows, size, t):
    out = []
    for i, text in rows:
        ids = np.array([*t.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        for k in range(0, len(ids), size):
            out.append((i, k // size, k, len(ids[k : k + size]), zlib.crc32(ids[k : k + size].tobytes())))
    return sorted(out, key=repr)


def test_words_are_known_without_case_and_marks():
    texts = ["The the. THE&&& Été été; It's it's", "x<|endoftext|> <|ENDOFTEXT|> <|endoftext|>.", "J\u030c \u01f0. a\u0338= e\u0301. I\u0307 \u0130 \u0178! a' a's 12.", "", "  "]
    known, t = ChunkEncoder(WORDS), Tokenizer.from_file(WORDS)
    ids, bounds = known.ids(pa.array(texts, pa.large_string()))
    for n, text in enumerate(texts):
        assert ids[bounds[n] : bounds[n + 1]].tolist() == t.encode(text, add_special_tokens=False).ids
    assert {"the", "été", ".", "&&&"} <= set(known.row) and not {"The", "the.", "THE&&&", "Été", "été;"} & set(known.row)
    small = ChunkEncoder(WORDS, remembered=0)  # forgets before each run
    for _ in range(2):
        assert np.array_equal(small.ids(pa.array(texts, pa.large_string()))[0], ids)


@pytest.mark.parametrize("size", [4096, 64])
def test_packing(spark, size):
    rows, t = hard_documents(), Tokenizer.from_file(WORDS)
    got = packing.packed(frame(spark, rows), WORDS, size).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == pieces_of(rows, size, t)
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in by.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= size
    assert len(by) <= 1.05 * -(-sum(r.length for r in got) // size) + 2
    assert packing.packed(frame(spark, []), WORDS, size).count() == 0


def held_by(plan, size):
    held = np.zeros(size + 1, np.int64)
    for pattern, copies in zip(plan.patterns, plan.copies, strict=True):
        assert sum(pattern) <= size and copies > 0
        np.add.at(held, np.array(pattern), copies)
    return held


def test_configuration_program():
    draw = np.random.default_rng(2)
    count = np.bincount(draw.integers(1, 101, 5000), minlength=101)
    plan = packing.solved(count, 100)
    assert (held_by(plan, 100) == count).all()
    least = (count * np.arange(101)).sum() / 100
    assert least - 1e-6 <= plan.bound <= plan.sequences <= 1.02 * least + 1


@pytest.mark.parametrize("rows", [300, 3000])
def test_the_program_places_pieces_where_few_share_a_length(rows):
    draw = np.random.default_rng(rows)
    count = np.bincount(np.minimum(draw.lognormal(5, 1, rows).astype(int) + 1, 1024), minlength=1025)
    plan = packing.solved(count, 1024)
    assert (held_by(plan, 1024) == count).all()
    assert plan.programmed > count.sum() * (0.3 if rows == 300 else 0.6)
    assert plan.sequences <= sum(n for _, n in packing.best_fit(count, 1024)) + 1


@pytest.mark.parametrize("lengths", [[], [7], [100], [100, 100, 1], [60] * 200])
def test_plans_of_few_lengths(lengths):
    count = np.bincount(lengths, minlength=101)
    plan = packing.solved(count, 100) if lengths else packing.Plan([], [], 0.0)
    assert (held_by(plan, 100) == count).all()


def test_patterns_of_the_program_are_used():
    count = np.zeros(101, np.int64)
    count[[60, 40, 35, 25, 20]] = 1000
    plan = packing.solved(count, 100)
    assert plan.programmed > 2500 and plan.sequences <= 1.02 * plan.bound + 1


def test_dual_bound_beats_the_volume_where_pieces_do_not_fit():
    count = np.zeros(101, np.int64)
    count[60] = 40
    assert packing.fractional(count, 100)[1] == pytest.approx(40)


@pytest.mark.parametrize("n", [1, 2, 3, 7, 1000, 4097])
def test_permutation_is_one_to_one_and_keyed(n):
    slots = materialize.Order(n, 9).slots(np.arange(n))
    assert sorted(slots.tolist()) == list(range(n))
    assert n < 100 or (slots != materialize.Order(n, 10).slots(np.arange(n))).mean() > 0.9


def test_shards(spark):
    rows, t = hard_documents(), Tokenizer.from_file(WORDS)
    made = materialize.materialize(frame(spark, rows), WORDS, stride=16, rows=100)
    got = materialize.read(spark, made).collect()
    want = []
    for i, text in rows:
        ids = np.array(t.encode(text or "", add_special_tokens=False).ids, "<u4")
        want += [(i, k, ids[16 * k : 16 * k + 16].tobytes()) for k in range(max(1, -(-len(ids) // 16)))]
    assert sorted(((r.doc_id, r.piece, bytes(r.ids)) for r in got), key=repr) == sorted(want, key=repr)
    assert sorted(r.slot for r in got) == list(range(len(want))) and all(r.shard == r.slot // 100 for r in got)
    later = materialize.read(spark, made, start=250).collect()
    assert sorted(r.slot for r in later) == list(range(250, len(want)))
    assert materialize.read(spark, materialize.materialize(frame(spark, []), WORDS)).count() == 0


def test_shards_are_files_that_a_task_can_hold(spark):
    docs = frame(spark, hard_documents())
    whole, cut = materialize.materialize(docs, WORDS, stride=16), materialize.materialize(docs, WORDS, stride=16, rows=100, part=32)
    record = materialize.record_type(16).itemsize
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*")
    assert whole.count > 8192
    assert max(r.length for r in files.load(whole.path).select("length").collect()) == 4096 * record
    assert {r.length // record for r in files.load(cut.path).where("shard = 1").select("length").collect()} == {32, 4}
    # The permutation is one of numbers alone, so how shards are cut moves nothing.
    columns = ["slot", "doc_id", "piece", "length", "ids"]
    places = [sorted((tuple(r) for r in materialize.read(spark, made).select(*columns).collect()), key=repr) for made in (whole, cut)]
    assert places[0] == places[1] and len(places[0]) == whole.count
    later = materialize.read(spark, cut, start=170).select("slot").collect()
    assert sorted(r.slot for r in later) == list(range(170, cut.count))
    parts = files.load(cut.path).where("shard = 1").select("part", "content").collect()
    held = {(1, r.part, i): x["piece"] for r in parts for i, x in enumerate(np.frombuffer(bytes(r.content), materialize.record_type(16)))}
    piece = {r.slot: r.piece for r in materialize.read(spark, cut).collect()}
    assert all(piece[100 + 32 * part + i] == x for (_, part, i), x in held.items())
