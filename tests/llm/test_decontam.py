"""Block-max WAND against scoring every segment, and the leaks of the query against plain search."""

import math
import random
from collections import Counter

import pyarrow as pa

from backglance.llm import decontam as dc
from backglance.llm.queries import QUERIES
from backglance.llm.words import words_of

SF = "/root/testdata/sf0.01"


def load(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    return sorted(docs), items


def index_of(items, least):
    rows = sorted(items, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    frequency, segments, total = dc.segment_counts([text for _, text in rows])
    return dc.build_index(rows, frequency, segments, total / max(1, segments), least)


def common(a, b):
    """Length of the longest common subsequence, by the table."""
    line = [0] * (len(b) + 1)
    for x in a:
        before = line[:]
        for j, y in enumerate(b):
            line[j + 1] = before[j] + 1 if x == y else max(before[j + 1], line[j])
    return line[-1]


def brute(docs, items, least=0.5, overlap=0.7):
    """(doc, item) and how many passages and segments score enough: BM25 and overlaps worked out here, nothing indexed."""
    segments = []
    for key, text in items:
        raw = text.encode().split()
        words = [dc.plain(w) for w in raw]
        ends = [i for i in range(1, len(raw)) if raw[i - 1][-1:] in b".!?"]
        at = ends[-1] if ends else len(raw) - max(1, len(raw) // 4)
        starts = [0] if len(words) <= 48 else [*range(0, len(words) - 48, 48), len(words) - 48]
        segments += [(key, words[s : s + 48], words[s : max(s, min(at, s + 48))], words[max(at, s) : s + 48]) for s in starts if words]
    mean = sum(len(s[1]) for s in segments) / len(segments)
    df = Counter(w for s in segments for w in set(s[1]))
    idf = {w: math.log(1 + (len(segments) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    weigh = lambda part: {w: idf[w] * t * 2.2 / (t + 1.2 * (0.25 + 0.75 * len(part) / mean)) for w, t in Counter(part).items()}
    weighed = [(*s, weigh(s[1])) for s in segments]
    found, retrieved = set(), 0
    for doc, text in docs:
        words = [dc.plain(w) for w in text.encode().split()]
        for start in range(0, max(1, len(words) - 32), 32):
            passage = set(words[start : start + 64])
            for key, _, question, answer, weights in weighed:
                if sum(s for w, s in weights.items() if w in passage) >= (least - 1e-9) * sum(weights.values()):
                    retrieved += 1
                    near = words[max(0, start - 48) : start + 64 + 48]
                    good = [n == 0 or common(p, near) >= (min(math.ceil(overlap * n - 1e-9), n - 1) if n > 1 else 1) for p, n in ((question, len(question)), (answer, len(answer)))]
                    if all(good):
                        found.add((doc, key))
    return found, retrieved


def test_query_against_brute_force(spark):
    docs, items = load(spark)
    wanted, retrieved = brute(docs, items)
    rows = QUERIES["op3_benchmark_leaks"](spark, SF).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == wanted and len(rows) == len(wanted)
    assert retrieved >= len(wanted) > 10


def test_search_finds_all_above_any_threshold(spark):
    docs, items = load(spark)
    index = index_of(items, 0.5)
    for _, text in docs[:60]:
        passage = {dc.plain(w) for w in text.encode().split()[:64]}
        terms = [index.terms[w] for w in passage if w in index.terms]
        score = {}
        for t in terms:
            for segment, impact in zip(index.postings[t], index.impacts[t]):
                score[segment] = score.get(segment, 0) + impact
        for least in (0.02, 0.05, 0.1, 0.5):
            got = dc.search(index, terms, least)
            assert {s for s, _ in got} == {s for s, v in score.items() if v >= least - 1e-9}
            assert all(abs(v - score[s]) < 1e-9 for s, v in got)


def test_long_items_several_indexes_and_stage(spark, monkeypatch):
    monkeypatch.setattr(dc, "MAX_ITEMS", 3)
    long = " ".join(f"w{i}" for i in range(300)) + ". the answer is forty two."
    items = spark.createDataFrame([(i, f"what is the {i}th of q{i} x{i} y{i}? it is z{i} v{i}.") for i in range(7)] + [(99, long)], "item_id long, text string")
    texts = ["clean text " * 50, f"before {long.upper()} after", "so WHAT is the 4th of q4 x4 y4? It is z4 v4. ok", "q4 x4 y4? and nothing else"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r.doc_id, r.item_id) for r in dc.find_leaks(docs, "doc_id", items).collect()}
    assert found == {(1, 99), (2, 4)}
    assert sorted(r.doc_id for r in dc.drop_leaks(docs, items).collect()) == [0, 3]


def test_passages_cover_every_word():
    for n in (0, 1, 31, 32, 33, 63, 64, 65, 96, 97, 200):
        words = words_of(pa.array([" ".join(map(str, range(n)))]))
        index = index_of([(1, str(n - 1))], 0.5)
        assert [(line[0], line[1]) for line in dc._leaks(index, pa.array([" ".join(map(str, range(n)))]), 0.5, 0.5)] == ([(0, 1)] if n else [])
        assert len(words.codes) == n


def test_words_in_order_against_the_table():
    draw = random.Random(3)
    for _ in range(300):
        a, b = ([draw.choice([b"a", b"b", b"c", b"d"]) for _ in range(draw.randint(0, 70))] for _ in range(2))
        assert dc.Wanted(a).in_order(b) == common(a, b)


def edited_items():
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("aeioulmnrst") for _ in range(draw.randint(2, 7)))
    items = []
    for i in range(60):
        question = [word() for _ in range(draw.randint(12, 90))]
        items.append((i, " ".join(question) + "? " + " ".join(word() for _ in range(draw.randint(2, 5))) + "."))
    return draw, word, items


def test_edited_items_and_excerpts_are_found_alike_in_any_number_of_indexes(spark, monkeypatch):
    draw, word, items = edited_items()
    texts, wanted = [], set()
    for key, text in items:
        words = text.split()
        words[draw.randrange(len(words))] = word()  # one word of question or answer
        texts.append(" ".join([*(word() for _ in range(draw.randint(0, 90))), *words, *(word() for _ in range(draw.randint(0, 90)))]))
        wanted.add((len(texts) - 1, key))
        if len(words) > 70:
            texts.append(" ".join(text.split()[:60]))  # a whole segment and more of a long item
            wanted.add((len(texts) - 1, key))
        texts.append(" ".join(word() for _ in range(200)))
        texts.append(" ".join(draw.sample(words, len(words))))  # the words out of order
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    frame = spark.createDataFrame(items, "item_id long, text string")
    found = dc.find_leaks(docs, "doc_id", frame).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted == brute(list(enumerate(texts)), items)[0]
    monkeypatch.setattr(dc, "MAX_ITEMS", 9)
    assert sorted(dc.find_leaks(docs, "doc_id", frame).collect()) == sorted(found)


def test_null_ids_repeated_rows_repeated_items_ties_and_clashing_columns(spark):
    item = "what is the river that runs past harbour town? it is the slow grey ember."
    items = spark.createDataFrame([(5, item, 1), (5, item, 2), (None, item, 3), (6, "", 4), (7, None, 5)], "item_id long, text string, part int")
    text = f"{item} {'filler words here ' * 40} {item}"
    rows = [(1, text, 0, "a"), (1, text, 0, "a"), (None, text, 1, "b"), (2, None, 2, "c"), (3, "", 3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, key int, item_id string")
    found = dc.find_leaks(docs, "doc_id", items).collect()
    assert Counter((r.doc_id, r.item_id) for r in found) == {(1, 5): 4, (1, None): 2, (None, 5): 2, (None, None): 1}
    assert {r.first_word for r in found} == {0} and {(r.question_overlap, r.answer_overlap) for r in found} == {(1.0, 1.0)}
    kept = dc.drop_leaks(docs, items)
    assert kept.dtypes == docs.dtypes and sorted(r.doc_id for r in kept.collect()) == [2, 3]


def test_a_text_longer_than_a_slice(spark):
    item = "what is the river that runs past harbour town? it is the slow grey ember."
    text = "plain words of no account " * 200_000 + item
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    items = spark.createDataFrame([(5, item)], "item_id long, text string")
    assert len(text) > 4 << 20
    (leak,) = dc.find_leaks(docs, "doc_id", items).collect()
    assert leak.item_id == 5 and abs(leak.first_word - 1_000_000) < 64
