"""BPE against the tokenizers library, and counts after edits against counting anew."""

import hashlib
import random
from functools import lru_cache

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from backglance.llm import bpe, edits
from backglance.llm.queries import QUERIES, byte_bpe

SF = "/root/testdata/sf0.01"
ODD = ["", "  a", "a  b", " a", " \n a", "x <|endoftext|> y<|endoftext|>", "don't I'll 'S １２３ ½ \x1c a", "日本語 🙂🙂", "a" * 3000,
       "\t\ttab \r\n\r\n x  ", "\x85x  y", "z 　 a　b", "a\x00b\x1f c\x1d d", "x᠎ y", "\x1c x"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(byte_bpe()["path"])


@pytest.fixture(scope="module")
def own():
    return bpe.load_bpe(**byte_bpe())


def wanted(library, text):
    ids = library.encode(text, add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()


def test_query_against_the_library(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: tuple(r)[1:] for r in QUERIES["op8_rank_array_bpe"](spark, SF).collect()}
    assert found == {r.doc_id: wanted(library, r.text or "") for r in rows}


def test_odd_texts(library, own):
    assert list(zip(*own.digests(pa.array(ODD)))) == [wanted(library, t) for t in ODD]
    assert [own.decode(own.encode(t)) for t in ODD] == ODD


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from(" \n'st")), max_size=40))
def test_any_text(text):
    own, library = bpe.load_bpe(**byte_bpe()), Tokenizer.from_file(byte_bpe()["path"])
    assert own.encode(text) == library.encode(text, add_special_tokens=False).ids
    assert list(zip(*own.digests(pa.array([text])))) == [wanted(library, text)]


def test_scan_and_heap_agree(own):
    draw = random.Random(1)
    for _ in range(500):
        word = bytes(draw.choice(b"abcdest er\xc3\xa9") for _ in range(draw.randint(1, 90)))
        assert own._short(word) == own._long(word)


def test_rows_together_agree_with_the_scan(own):
    """Many pre-tokens at once, over several blocks, give the parts of each alone."""
    draw = random.Random(5)
    words = [bytes(draw.choice(b"abcdest er\xc3\xa9 ing") for _ in range(draw.randint(0, 140))) for _ in range(400)]
    words += [bytes(draw.choice(b" theinr") for _ in range(draw.randint(1, 9))) for _ in range(9000)]
    flat, first = own.pretokens(pa.array(words, pa.large_binary()))
    for i, word in enumerate(words):
        bounds = own._short(word) if word else [0]
        assert flat[first[i] : first[i + 1]].tolist() == [own.ids[word[a:b]] for a, b in zip(bounds, bounds[1:])]


@lru_cache
def the_library():
    return Tokenizer.from_file(byte_bpe()["path"])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("aZé×÷9½.$'s\n\tß日 "), max_size=9), min_size=1, max_size=9))
def test_pieces_by_their_bytes_and_by_the_pattern(texts):
    own, library = bpe.load_bpe(**byte_bpe()), the_library()
    joined = " ".join(texts)
    assert list(zip(*own.digests(pa.array([joined, None, joined + "."])))) == [wanted(library, t) for t in (joined, "", joined + ".")]


def test_redactions_in_one_pass(spark):
    rows = [(1, "mail a.b@c.de or 1234567"), (2, None), (None, "  two  spaces 99999 é"), (3, ""), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    one = edits.count_redacted(docs, **byte_bpe()).collect()
    assert sorted(map(str, one)) == sorted(map(str, edits.count_edited(edits.with_redactions(docs), **byte_bpe()).collect()))


def test_frames_round_trip(spark):
    texts = spark.createDataFrame([(i, t) for i, t in enumerate([*ODD, None])], "n long, text string")
    back = bpe.decode_documents(bpe.encode_documents(texts, **byte_bpe()), **byte_bpe()).collect()
    assert all(r.decoded == (r.text or "") for r in back) and len(back) == len(ODD) + 1


def edit_lists():
    piece = st.text(alphabet=st.sampled_from("ab e1'\n\t. é"), max_size=30)
    return st.tuples(piece, st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.text(alphabet="a 'é\n", max_size=6)), max_size=5))


@settings(max_examples=300, deadline=None)
@given(edit_lists())
def test_edits_count_like_the_edited_text(case):
    text, raw = case
    own = bpe.load_bpe(**byte_bpe())
    changes, last = [], 0
    for a, b, new in sorted((min(a, b), max(a, b), n) for a, b, n in raw):
        if last <= a and b <= len(text):
            changes.append((a, b, new))
            last = b
    tree = edits.TokenTree.build(text, own)
    assert tree.total == len(own.encode(text))
    tree.apply(changes, own)
    assert tree.total == len(own.encode(edits.apply_to_text(text, changes)))
    size = len(tree.sums) // 2
    assert all(tree.sums[i] == tree.sums[2 * i] + tree.sums[2 * i + 1] for i in range(1, size))


def test_overlapping_or_outside_edits_are_errors(own):
    for bad in ([(0, 3, ""), (2, 4, "")], [(0, 99, "")], [(-1, 0, "")]):
        with pytest.raises(ValueError):
            edits.TokenTree.build("some text", own).apply(bad, own)


def test_edit_query_against_counting_anew(spark, library):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    found = {r.doc_id: r for r in QUERIES["op5_edited_token_counts"](spark, SF).collect()}
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    for row in rows:
        line, changes = found[row.doc_id], edits.redactions(row.text or "")
        assert line.n_tokens == count(row.text or "") and line.n_edits == len(changes)
        assert line.n_tokens_edited == count(edits.apply_to_text(row.text or "", changes))
        assert line.n_encoded_again <= 8 * max(1, line.n_edits)
    assert sum(r.n_edits for r in found.values()) > 20
