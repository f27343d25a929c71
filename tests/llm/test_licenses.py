"""Patience alignment, and the licence query against a plain search for the notices."""

import random

import pyarrow as pa

from backglance.llm import licenses
from backglance.llm.decontam import plain
from backglance.llm.license_texts import TEMPLATES
from backglance.llm.queries import QUERIES
from backglance.llm.words import words_of

SF = "/root/testdata/sf0.01"


def test_alignment_is_increasing_and_equal():
    draw = random.Random(5)
    for _ in range(300):
        template = [draw.choice("abcdefghijklmnop") for _ in range(draw.randint(0, 12))]
        text = [w for w in template if draw.random() > 0.2]
        text[draw.randint(0, len(text)) : 0] = [draw.choice("abcxyz") for _ in range(draw.randint(0, 6))]
        matched = licenses.align(text, template)
        assert all(text[i] == template[j] for i, j in matched)
        assert all(a < c and b < d for (a, b), (c, d) in zip(matched, matched[1:]))
    assert licenses.align("abcdef", "abcdef") == [(i, i) for i in range(6)]
    assert licenses.align("xxabyycdzz", "abcd") == [(2, 0), (3, 1), (6, 2), (7, 3)]


def test_longest_increasing_against_brute_force():
    draw = random.Random(6)
    for _ in range(200):
        seconds = draw.sample(range(30), draw.randint(0, 9))
        pairs = list(enumerate(seconds))
        best = 0
        for mask in range(1 << len(pairs)):
            chosen = [s for k, s in enumerate(seconds) if mask >> k & 1]
            best = max(best, len(chosen)) if chosen == sorted(chosen) else best
        assert len(licenses._longest_increasing(pairs)) == best


def test_every_notice_is_found_wherever_it_stands(spark):
    draw = random.Random(7)
    noise = lambda n: " ".join(draw.choice(["the", "of", "work", "license", "is", "version", "a", "to"]) for _ in range(n))
    rows = [(i, f"{noise(draw.randint(0, 400))}. {text}\n{noise(draw.randint(0, 300))}") for i, text in enumerate(TEMPLATES.values())]
    found = licenses.find_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.license) for r in found} >= set(enumerate(TEMPLATES))


def test_edited_notices_by_coverage():
    template = [plain(w) for w in TEMPLATES["mit-permission"].encode().split()]
    words = TEMPLATES["mit-permission"].split()
    most = " ".join(w for i, w in enumerate(words) if i % 10)
    half = " ".join(words[: len(words) // 2])
    found = licenses.scan(words_of(pa.array([most, half, most + " and " + most])), {"mit": template})
    assert [line[0] for line in found] == [0, 2] and all(line[2] >= 0.8 for line in found)


def test_query_against_plain_search(spark):
    def has(text, notice):
        words, wanted = [plain(w) for w in text.encode().split()], [plain(w) for w in notice.encode().split()]
        return any(words[i : i + len(wanted)] == wanted for i in range(len(words) - len(wanted) + 1))

    short = {n: t for n, t in TEMPLATES.items() if len(t.split()) < 15}
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    wanted = {(r.doc_id, n) for r in rows for n, t in short.items() if has(r.text or "", t)}
    found = QUERIES["op6_license_alignment"](spark, SF).collect()
    assert wanted == {(r.doc_id, r.license) for r in found if r.coverage == 1.0 and r.license in short}
    assert len(wanted) > 20


def test_foreign_passages_of_any_length_inside_a_notice():
    words = TEMPLATES["mit-permission"].split()
    template = {"mit": [plain(w.encode()) for w in words]}
    common = ["the", "of", "to", "and", "use", "any", "foreign", "passage"]
    draw = random.Random(11)
    for gap in (0, 10, 40, 60, 200, 5000):
        for at in (7, 30, 43, 80):
            for noise in (["foreign"] * gap, [draw.choice(common) for _ in range(gap)]):
                text = " ".join([*words[:at], *noise, *words[at:]])
                (line,) = licenses.scan(words_of(pa.array([text])), template)
                assert line[2] >= 1 - 3 / len(words) and line[3] == 0 and line[4] == len(words) + gap - 1, (gap, at, line)
    pieces = [w for i in range(0, 86, 11) for w in [*words[i : i + 11], *["other"] * 300]]
    (line,) = licenses.scan(words_of(pa.array([" ".join(pieces)])), template)
    assert line[2] == 1.0 and line[5] == len(words)


def test_scattered_words_and_shuffled_pieces_are_no_notice():
    words = TEMPLATES["mit-permission"].split()
    template = {"mit": [plain(w.encode()) for w in words]}
    scattered = [w for word in words for w in [word, *["other"] * 40]]
    shuffled = [w for i in range(80, -1, -5) for w in [*words[i : i + 5], *["other"] * 200]]
    assert licenses.scan(words_of(pa.array([" ".join(scattered), " ".join(shuffled)])), template) == []


def longest_common(a, b):
    line = [0] * (len(b) + 1)
    for x in a:
        before = line[:]
        for j, y in enumerate(b):
            line[j + 1] = before[j] + 1 if x == y else max(before[j + 1], line[j])
    return line[-1]


def test_coverage_of_edited_notices_against_the_longest_common_subsequence():
    draw = random.Random(12)
    for name in ("mit-permission", "apache-2.0-header", "isc"):
        words = TEMPLATES[name].split()
        template = [plain(w.encode()) for w in words]
        for _ in range(40):
            share = draw.random() * 0.3
            text = [w if draw.random() > share else draw.choice(["changed", "the", ""]) for w in words]
            text = [*["before"] * draw.randint(0, 30), *text, *["after"] * draw.randint(0, 30)]
            true = longest_common([plain(w.encode()) for w in " ".join(text).split()], template) / len(template)
            found = licenses.scan(words_of(pa.array([" ".join(text)])), {name: template})
            assert bool(found) == (true >= 0.8) or abs(true - 0.8) < 0.04
            assert not found or 0 <= true - found[0][2] < 0.04


def test_ties_nulls_repeated_rows_and_clashing_columns(spark):
    notice = TEMPLATES["mit-permission"]
    rows = [(1, f"{notice} between {notice}", "a", 1), (None, notice, "b", 2), (3, None, "c", 3), (3, "", "c", 3), (4, notice, "d", 4), (4, notice, "d", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license string, coverage int")
    found = [r for r in licenses.find_licenses(docs).collect() if r.license == "mit-permission"]
    assert sorted((r.doc_id or 0, r.first_word, r.coverage) for r in found) == [(0, 0, 1.0), (1, 0, 1.0), (4, 0, 1.0), (4, 0, 1.0)]
    long = spark.createDataFrame([(9, "plain words here " * 300_000 + notice)], "doc_id long, text string")
    assert {(r.license, r.first_word) for r in licenses.find_licenses(long).collect()} == {("mit-permission", 900_000)}
