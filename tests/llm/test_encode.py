import os
import random

import pytest
from tokenizers import Tokenizer

from minespark.llm import tokenizer
from minespark.llm.encode import LONG_TEXT, UNIT, cut_text, encode_corpus, join_leaves, join_two, long_ids
from minespark.llm.registry import p6_ids

np = pytest.importorskip("numpy")
PIECES = ["a", "th", "the", "ation", "ing", "=", "-", "_", "'", "'s", " ", "  ", "\n", "\t", " ", "　", "\x1c", "中", "日", "é", "é", "1", "23", "😀", "<|endoftext|>"]


@pytest.fixture(scope="module")
def bpe():
    return tokenizer.load()


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(os.path.join(tokenizer.FOLDER, "byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return lambda text: t.encode(text, add_special_tokens=False).ids if text else []


def by_units(bpe, text, unit):
    pieces = {}
    for piece, leaf, part, whole in cut_text(bpe, text, unit):
        pieces.setdefault(piece, []).append(bpe.encode(part.decode()) if whole else np.array(bpe.encode_piece(part), np.int32))
    return [int(i) for p in sorted(pieces) for i in join_leaves(bpe, pieces[p])]


def texts(seed, n, longest):
    rnd = random.Random(seed)
    for _ in range(n):
        some = rnd.sample(PIECES, rnd.choice([1, 2, 4, len(PIECES)]))
        yield "".join(rnd.choice(some) for _ in range(rnd.randrange(longest)))


@pytest.mark.parametrize("unit", [1, 3, 10, 40])
def test_units_give_the_encoders_ids(bpe, reference, unit):
    for text in texts(unit, 400, 200):
        want = reference(text)
        assert by_units(bpe, text, unit) == want
        assert b"".join(c[2] for c in cut_text(bpe, text, unit)) == text.encode()


def test_long_unsplit_piece(bpe, reference):
    rnd = random.Random(1)
    text = "".join(rnd.choice(["ation", "the", "ing", "x", "qu"]) for _ in range(3000))
    assert by_units(bpe, text, 500) == reference(text)
    for text in ("a" * 5000, "=" * 5000, " " * 3000 + "x", "\n" * 999, "ab" * 2000):
        assert by_units(bpe, text, 100) == reference(text)


def test_join_two_agrees_at_any_cut(bpe):
    text = b"internationalizationsupercalifragilistic"
    whole = bpe.encode_piece(text)
    for cut in range(len(text) + 1):
        parts = [np.array(bpe.encode_piece(x), np.int32) for x in (text[:cut], text[cut:])]
        assert join_two(bpe, *parts, window=1).tolist() == whole


def test_corpus(spark, reference):
    long = "hello world " * 40 + "z" * 300 + "\n\n\nthe end. " + "中文" * 90
    rows = [(1, "a b"), (2, None), (3, ""), (None, "x"), (None, long), (4, long), (4, long), (5, " \n\t "), (6, "<|endoftext|> <pad>"), (7, "é😀" * 100)]
    df = spark.createDataFrame([(i, t, 0, "k") for i, t in rows], "doc_id long, text string, n int, text_key string")
    got = encode_corpus(df, doc_id="doc_id", text="text", long_text=100, unit=30).collect()
    assert sorted(((r.doc_id, list(r.ids)) for r in got), key=repr) == sorted(((i, reference(t)) for i, t in rows), key=repr)


UNSPLIT = "".join(random.Random(8).choice(["ation", "the", "ing", "é", "qu", "中"]) for _ in range(6000))  # nothing splits it


def test_the_tree_of_an_unsplit_text_is_joined_by_several_tasks(spark, reference):
    """About 300 leaves, 20 to a task, whose results are joined again; with text around it, and again for a repeated row."""
    text = "It says: " + UNSPLIT + " -- the end."
    df = spark.createDataFrame([(1, text), (1, text), (None, UNSPLIT), (2, "a " * 3000)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, list(r.ids)) for r in long_ids(df, "byte_bpe_50k", tokenizer.FOLDER, unit=60, joined_at_once=20).collect()), key=lambda x: x[0])
    assert got == [(0, reference(UNSPLIT)), *[(1, reference(text))] * 2, (2, reference("a " * 3000))]


def test_a_long_unsplit_text_goes_through_the_query(spark, reference, tmp_path):
    """p6_ids with its own limits: the text exceeds both the length of a long text and that of a leaf, so leaves are joined."""
    texts = [UNSPLIT, "short", None, "x" * 9000, " " * 5000 + UNSPLIT[:5000]]
    assert len(UNSPLIT) > LONG_TEXT and len(UNSPLIT) > 4 * UNIT
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    leaves = [cut_text(tokenizer.load(), t, UNIT) for t in texts if t and len(t) > LONG_TEXT]
    assert [sum(not whole for *_, whole in x) for x in leaves] == [8, 4, 4]  # white space and what follows it are two pieces
    got = {r.doc_id: list(r.ids) for r in p6_ids(spark, str(tmp_path)).collect()}
    assert got == {i: reference(t) if t else [] for i, t in enumerate(texts)}


def test_empty(spark):
    assert encode_corpus(spark.createDataFrame([], "doc_id long, text string"), doc_id="doc_id", text="text").collect() == []
