"""Word splitting, token ids, token files and packing against the libraries themselves."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from callweave.llm import packing, token_files, tokens, words
from callweave.llm.common import table

from llm_helpers import SF_SMALL, docs_of  # noqa: F401

TEXT = st.text(alphabet=st.one_of(st.sampled_from(" \t\n\x0b\x0c\r'.,!#&-+@'é×ÉßæİΣςé  <=≯١²Ⅷ中0aAzZsS"), st.characters(exclude_categories=["Cs"])), max_size=60)


def whole(text):
    return tokens.encoder(tokens.vocabulary()).tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), max_size=6))
def test_ids_equal_the_whole_text_s(rows):
    got = {k: ids.tolist() for k, ids in tokens.encode(pa.array(rows, pa.string()), tokens.vocabulary())}
    assert got == {k: [*whole(t), tokens.END_ID] for k, t in enumerate(rows)}


MARKED = st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext|", "'s", "\u0301", " "]), TEXT), max_size=8).map("".join)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), MARKED), max_size=6))
def test_ids_equal_the_whole_text_s_with_added_tokens(rows):
    for column in (pa.array(rows, pa.string()), pa.array(["<|endoftext|>", *rows], pa.string())[1:]):
        got = {k: ids.tolist() for k, ids in tokens.encode(column, tokens.vocabulary())}
        assert got == {k: [*whole(t), tokens.END_ID] for k, t in enumerate(rows)}


def test_added_tokens_keep_their_id(monkeypatch):
    monkeypatch.setattr(words, "SLICE", 20)
    rows = ["see <|endoftext|> here", "<|startoftext|>" * 3 + "word " * 30 + "<|endoftext|>", "plain"]
    got = [ids.tolist() for _, ids in tokens.encode(pa.array(rows), tokens.vocabulary())]
    assert got == [[*whole(t), 2] for t in rows]
    assert got[0] == [862, 49407, 763, 2]


def test_op1_and_op9_read_added_tokens(spark, docs_of, tmp_path):
    rows = [(1, "a <|endoftext|> b"), (2, "c<|startoftext|>"), (3, "<|endoftext|>"), (4, "d")]
    check_packing(packing.pack_documents(docs_of(rows)).collect(), rows)
    manifest = token_files.write_token_files(docs_of(rows), f"{tmp_path}/ids")
    got = [tuple(r) for r in token_files.read_token_files(spark, manifest).orderBy("start").collect()]
    want, at = [], 0
    for d, t in rows:
        ids = [*whole(t), 2]
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t.'é", max_size=30), max_size=8))
def test_words_equal_split(rows):
    got, flat = {}, {}
    for w in words.words(pa.array(rows, pa.string())):
        at = 0
        for k, n in enumerate(w.count.tolist()):
            got.setdefault(w.row + k, []).extend(w.word(i).decode() for i in range(at, at + n))
            for i in range(at, at + n):
                flat.setdefault(w.word(i), set()).add(int(w.hash[i]))
            at += n
    ascii_words = lambda t: [x for x in t.replace("\n", " ").replace("\t", " ").split(" ") if x]
    assert got == {k: ascii_words(t) for k, t in enumerate(rows)}
    assert all(len(h) == 1 for h in flat.values()) and len({next(iter(h)) for h in flat.values()}) == len(flat)


def test_long_texts_are_cut_between_words(monkeypatch):
    monkeypatch.setattr(words, "SLICE", 50)
    rows = ["a " * 100 + "x" * 200 + " end", "", None, "b", "tail it's " * 30]
    got = {k: ids.tolist() for k, ids in tokens.encode(pa.array(rows, pa.string()), tokens.vocabulary())}
    assert got == {k: [*whole(t), tokens.END_ID] for k, t in enumerate(rows)}
    counts = {row + k: n for row, c, _ in words.texts(pa.array(rows, pa.string())) for k, n in enumerate(c.tolist())}
    assert counts == {k: len((t or "").split()) for k, t in enumerate(rows)}


def test_the_cache_starts_afresh(monkeypatch):
    monkeypatch.setattr(tokens, "KEEP_BYTES", 60)
    monkeypatch.setattr(words, "SLICE", 8)
    rows = [" ".join(f"w{i}" for i in range(40))]
    assert [ids.tolist() for _, ids in tokens.encode(pa.array(rows), tokens.vocabulary())] == [[*whole(rows[0]), 2]]


@pytest.mark.parametrize("ids", [[5], [7] * 3000, list(range(5000)), [1] * 4000 + [49_000] * 30 + [2**32 - 1], [0, 2**32 - 1]])
def test_blocks_round_trip(ids):
    a = np.array(ids, dtype=np.uint32)
    for k in range(0, len(a), token_files.BLOCK):
        part = a[k:k + token_files.BLOCK]
        assert token_files.unpack_block(token_files.pack_block(part)).tolist() == part.tolist()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files_round_trip(spark, docs_of, tmp_path):
    rng = random.Random(1)
    rows = [(rng.randrange(10**9), " ".join(rng.choice(["The", "cat", "sat!", "42", "é"]) for _ in range(rng.randrange(300)))) for _ in range(60)]
    rows += [(None, "no id"), (None, None), (3, None), (3, "b"), (3, "a"), (9, ""), (10, "long " * 30000)]
    manifest = token_files.write_token_files(docs_of(rows), f"{tmp_path}/ids", shard_bytes=4000, file_ids=500)
    assert manifest.count() > 3
    got = [tuple(r) for r in token_files.read_token_files(spark, manifest).orderBy("start", F.asc_nulls_first("doc_id"), "n_tokens").collect()]
    hashes = {r.text: r.h for r in docs_of(rows).select("text", F.xxhash64("text").alias("h")).collect()}
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashes[r[1]]))  # rows of one id by a hash of the text
    want, at = [], 0
    for d, t in order:
        ids = [*whole(t), 2]
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert got == want
    assert not [f for f in (tmp_path / "ids").iterdir() if f.name.startswith("_") and not f.name.endswith(".crc")]


def test_no_documents(spark, docs_of):
    none = docs_of([])
    assert token_files.read_token_files(spark, token_files.write_token_files(none)).collect() == []
    assert packing.pack_documents(none).collect() == []


def test_op9_matches_brute_force(spark):
    from callweave.llm.queries import op9_token_files

    docs = sorted(((r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()), key=lambda r: r[0])
    want, at = [], 0
    for d, t in docs:
        ids = [*whole(t), 2]
        want.append((d, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(tuple(r) for r in op9_token_files(spark, SF_SMALL).collect()) == want


def check_packing(rows, texts, length=packing.SEQUENCE):
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault((r.doc_id, r.doc_tokens), []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for got in by_seq.values():
        at = 0
        for r in sorted(got, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= length and len(got) <= packing.SEGMENTS
    pieces = sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    want = []
    for d, t in texts:
        ids = [*whole(t), 2]
        cut = min(length, packing.LOSS_TOKENS)
        want += [(-1 if d is None else d, k, len(ids[k:k + cut]), crc(ids[k:k + cut]), len(ids)) for k in range(0, len(ids), cut)]
    assert pieces == sorted(want)
    return by_seq


def test_op1_matches_brute_force(spark):
    from callweave.llm.queries import op1_packing

    rows = op1_packing(spark, SF_SMALL).collect()
    by_seq = check_packing(rows, [(r.doc_id, r.text) for r in table(spark, SF_SMALL, "documents").collect()])
    used = [sum(r.length for r in s) for s in by_seq.values()]
    padding = sum(0 if n & (n - 1) == 0 else packing.SEQUENCE - n for n in used)
    assert padding <= 0.03 * sum(used) + packing.SEQUENCE


def test_each_limit_binds_in_documents(spark, docs_of):
    """Short documents fill the segments, long pieces the loss-bearing tokens, others the tokens."""
    rng = random.Random(6)
    words_of = lambda n: " ".join(rng.choice(["cat", "dog", "sun"]) for _ in range(n))
    full = []
    for sizes in ([1] * 400, [200] * 200, [rng.randrange(60, 90) for _ in range(300)]):
        rows = [(k, words_of(n)) for k, n in enumerate(sizes)]
        got = packing.pack_documents(docs_of(rows)).collect()
        check_packing(got, rows)
        sums = {}
        for r in got:
            t = sums.setdefault(r.sequence_id, [0, 0, 0])
            t[0], t[1], t[2] = t[0] + r.length, t[1] + 1, t[2] + r.loss_tokens
        assert all(a <= packing.SEQUENCE and b <= packing.SEGMENTS and c <= packing.LOSS_TOKENS for a, b, c in sums.values())
        full.append([max(t[i] for t in sums.values()) for i in range(3)])
    assert full[0][1] == packing.SEGMENTS and full[0][0] < packing.SEQUENCE / 2
    long = packing.pack_documents(docs_of([(1, words_of(20000))])).collect()
    assert max(r.loss_tokens for r in long) == packing.LOSS_TOKENS and max(r.length for r in long) < packing.SEQUENCE
    assert max(f[0] for f in full) > packing.SEQUENCE - 90


def test_ids_stay_as_they_are(spark, docs_of):
    rows = [(None, "a"), (2**60 + 1, "b c"), (2**60 + 3, "d e f"), (2**63 - 1, "g"), (-(2**63), "h"), (None, None)]
    got = packing.pack_documents(docs_of(rows)).collect()
    check_packing(got, rows)
    assert sorted((r.doc_id for r in got), key=str) == sorted((d for d, _ in rows), key=str)


UNSPACED = ["中文，标点。" * 700, "a" * 3000 + "1" * 900 + "," + "é" * 800, "x'sy-" * 900, "日本語" * 900 + "\u0301!" * 40, "１２３，" * 300 + "b"]


def test_long_pieces_are_not_kept(monkeypatch):
    monkeypatch.setattr(tokens, "PART_CHARS", 64)
    for size in (words.SLICE, 100):
        monkeypatch.setattr(words, "SLICE", size)
        rows = [*UNSPACED, "short words", UNSPACED[0] + " short " + UNSPACED[1]]
        enc = tokens.encoder(tokens.vocabulary())
        enc.clear()
        got = [ids.tolist() for _, ids in tokens.encode(pa.array(rows), tokens.vocabulary())]
        assert got == [[*whole(t), 2] for t in rows]
        assert enc.used < 200


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab中é,'-1² \n\u0301"), max_size=80), st.integers(1, 12))
def test_words_longer_than_a_slice(text, size):
    """The same words, pieces and hashes whatever the slices."""
    column = pa.array([text, "x"])
    for pieces in (False, True):
        want = [(w.word(i), int(h)) for w in words.words(column, lower=True, pieces=pieces) for i, h in enumerate(w.hash)]
        old = words.SLICE
        try:
            words.SLICE = size
            got = [(w.word(i), int(h)) for w in words.words(column, lower=True, pieces=pieces) for i, h in enumerate(w.hash)]
        finally:
            words.SLICE = old
        assert got == want


def test_memory_of_a_long_text_without_spaces():
    """50 MB without white space, under a limit of 1.5 GB on top of what importing takes."""
    import subprocess
    import sys
    from pathlib import Path

    code = """
import resource
import pyarrow as pa
from callweave.llm import tokens, words
text = pa.array(["中文，标点。" * (50_000_000 // 18)])
list(tokens.encode(pa.array(["warm up"]), tokens.vocabulary()))
now = int(open("/proc/self/statm").read().split()[0]) * resource.getpagesize()
resource.setrlimit(resource.RLIMIT_AS, (now + (3 << 29), now + (3 << 29)))
assert sum(len(w.hash) for w in words.words(text)) == 1
(_, ids), = tokens.encode(text, tokens.vocabulary())
print(len(ids))
"""
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parents[2], capture_output=True, text=True, timeout=600)
    assert done.returncode == 0 and int(done.stdout) > 10_000_000, done.stderr[-2000:]


def test_packing_edge_rows(spark, docs_of):
    rows = [(1, None), (2, ""), (None, "x"), (3, "same"), (3, "same"), (4, "word " * 9000)]
    check_packing(packing.pack_documents(docs_of(rows)).collect(), rows)


def test_every_limit_holds(spark):
    rng = random.Random(2)
    data = [(i, rng.randrange(1, 400), 1, rng.randrange(0, 120)) for i in range(2000)]
    pieces = spark.createDataFrame(data, "id long, tokens long, segments long, loss long")
    limits = {"tokens": 1000, "segments": 9, "loss": 300}
    got = packing.pack(pieces, limits, ("id",), group_rows=500).toPandas()
    assert sorted(got["id"]) == list(range(2000))
    sums = got.groupby("sequence_id")[["tokens", "segments", "loss"]].sum()
    assert (sums <= [1000, 9, 300]).all().all()
    least = max(sum(r[1] for r in data) / 1000, 2000 / 9, sum(r[3] for r in data) / 300)
    assert len(sums) <= 1.15 * least + 8
    again = packing.pack(pieces.repartition(5), limits, ("id",), group_rows=500).toPandas()
    assert dict(zip(got["id"], got["sequence_id"], strict=True)) == dict(zip(again["id"], again["sequence_id"], strict=True))


def test_a_piece_that_fits_nowhere_is_an_error():
    with pytest.raises(ValueError, match="larger than a sequence"):
        packing.fill(np.array([[5.0, 1.0]]), np.array([4.0, 9.0]))
