"""Repeated passages found by recompression.

Rounds rename the words of all documents: first every run of one word becomes one symbol, then
in each round two neighbours become one symbol where the left one's name falls in the left
half of all names and the right one's in the right half.  A name is a hash of the names it is
made from, so it is the same wherever the same words stand, and a round needs no dictionary.
Only symbols of few words join in a round; then equal windows have equal symbols inside but
for a bounded number of words at either end (``edge``).

1. Every bucket of documents sends the names of its longer symbols, each once, to the task that
   compares them; names that two buckets have, or one bucket twice, are shared.
2. A window may repeat only if all symbols over its middle are shared.  The windows that
   remain are verified: a hash of all their words goes to the task that compares them, with
   the first place the bucket has it at, and all but the earliest place come back.
3. Words under a window that came back are repeats.

Buckets hold a bounded number of bytes, so their number follows the input.  A name or a window
costs one entry per bucket, however often it occurs there, so a passage found in a third of
all rows loads no task.  ``repeat_digests`` counts rows of equal id and text before the shuffle,
so a bucket has such a row once; the later ones follow from the count.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from backglance.llm.words import Words, words_of
from backglance.sources.tables import pin

WINDOW = 20
# Words of the longest symbols that may still join, by round.
ROUNDS = (1, 1, 2, 2)
# Symbols of fewer words are not compared: they are often shared by chance.
LEAST = 3
# Bytes of text to a bucket: what one task holds at a time.
BUCKET_BYTES = 4 << 20
_LAST = (1 << 63) - 1
# Lines of one repeated row that are written out at a time.
_RUN = 100_000

_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(z: np.ndarray) -> np.ndarray:
    z = (z ^ (z >> np.uint64(30))) * _A
    z = (z ^ (z >> np.uint64(27))) * _B
    return z ^ (z >> np.uint64(31))


def edge(rounds: tuple[int, ...]) -> int:
    """Words at either end of a window that may fall into different symbols elsewhere.

    A run, or a round, can take at most the outermost symbol that is equal everywhere, and only
    if that symbol may still join.
    """
    return 1 + sum(rounds)


def _word_names(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit names of every word."""
    digests = b"".join([xxhash.xxh3_128_digest(w) for w in words.vocabulary.to_pylist()])
    pairs = np.frombuffer(digests, "<u8").reshape(-1, 2)
    return pairs[words.codes, 0], pairs[words.codes, 1]


def _symbols(names: np.ndarray, first: np.ndarray, rounds: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Name and number of words of each symbol after all rounds; runs are told by a length of their own."""
    n = len(names)
    starts = np.zeros(n + 1, bool)
    starts[first] = True
    starts = starts[:-1]
    head = starts.copy()
    head[:1] = True
    head[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(head)
    lengths = np.diff(np.append(at, n))
    names, starts = names[at], starts[at]
    run = lengths > 1
    # A run is named by its word alone: its length may differ outside a window.  It joins no more.
    names = np.where(run, _mix(names ^ np.uint64(0x52554E)), names)
    active = ~run
    for number, most in enumerate(rounds, 1):
        able = active & (lengths <= most)
        left = (_mix(names + np.uint64(977 * number)) & np.uint64(1)).astype(bool)
        joins = able[:-1] & able[1:] & left[:-1] & ~left[1:] & ~starts[1:]
        at = np.flatnonzero(joins)
        names, lengths = names.copy(), lengths.copy()
        names[at] = _mix(_mix(names[at] + np.uint64(number)) * np.uint64(3) + names[at + 1])
        lengths[at] += lengths[at + 1]
        keep = np.ones(len(names), bool)
        keep[at + 1] = False
        names, lengths, starts, active = names[keep], lengths[keep], starts[keep], active[keep]
    return names, lengths


def _window_hashes(names: np.ndarray, window: int, seed: int) -> np.ndarray:
    """A hash of the names of each ``window`` consecutive words, by doubling."""
    total, width, place = None, 0, 0
    power, size = names, 1
    while True:
        if window & size:
            part = power[place:] if place else power
            if total is None:
                total = part
            else:
                m = min(len(total), len(part))
                total = _mix(total[:m] * np.uint64(0x9E3779B97F4A7C15) + part[:m] + np.uint64(seed))
            place += size
        size *= 2
        if size > window:
            return total[: max(0, len(names) - window + 1)]
        half = size // 2
        power = _mix(power[:-half] * np.uint64(0xD6E8FEB86659FD93) + power[half:] + np.uint64(seed + size)) if len(power) > half else power[:0]


def _in_order(table: pa.Table) -> pa.Table:
    """The rows of a bucket in an order that does not depend on the shuffle."""
    return table.sort_by([("_key", "ascending"), ("_print", "ascending")])


def _lists(values: np.ndarray, ends: np.ndarray, kind) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, kind))


def _by_group(groups: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order that puts equal groups together, the groups, and where each ends."""
    order = np.argsort(groups, kind="stable")
    found, counts = np.unique(groups[order], return_counts=True)
    return order, found, np.cumsum(counts)


def _flat(column: pa.ChunkedArray, kind) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = lists.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    return flat.to_numpy(zero_copy_only=False).astype(kind)


def _lengths(column: pa.ChunkedArray) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(column), 0).to_numpy().astype(np.int64)


_NAMES = "target int, bucket int, names array<bigint>"
_SHARED = "bucket int, names array<bigint>, copies array<bigint>"
_WINDOWS = (
    "target int, bucket int, high array<bigint>, low array<int>, doc array<bigint>, place array<int>, known array<int>"
)
_REPEATS = "bucket int, places array<int>"


def _names_of(targets: int, rounds, least: int) -> Callable[[pa.Table], pa.Table]:
    def run(table: pa.Table) -> pa.Table:
        words = words_of(table["text"])
        names, lengths = _symbols(_word_names(words)[0], words.first, rounds)
        names = np.unique(names[lengths >= least])
        order, found, ends = _by_group((names % np.uint64(targets)).astype(np.int32))
        bucket = pa.array(np.full(len(found), table["bucket"][0].as_py(), np.int32))
        return pa.table({"target": found, "bucket": bucket, "names": _lists(names[order].view(np.int64), ends, pa.int64())})

    return run


def _shared_names(table: pa.Table) -> pa.Table:
    """By bucket, the names that some other bucket has too."""
    names = _flat(table["names"], np.int64)
    buckets = np.repeat(table["bucket"].to_numpy(), _lengths(table["names"]))
    order = np.argsort(names, kind="stable")
    ordered = names[order]
    same = ordered[1:] == ordered[:-1]
    shared = np.zeros(len(names), bool)
    shared[order[1:][same]] = True
    shared[order[:-1][same]] = True
    names, buckets = names[shared], buckets[shared]
    order, found, ends = _by_group(buckets)
    names = _lists(names[order], ends, pa.int64())
    return pa.table({"bucket": pa.array(found, pa.int32()), "names": names, "copies": pa.nulls(len(found), pa.list_(pa.int64()))})


def _windows_of(targets: int, window: int, rounds, least: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    inner = edge(rounds)

    def run(table: pa.Table, shared: pa.Table) -> pa.Table:
        if not table.num_rows:
            return T_EMPTY_WINDOWS
        table = _in_order(table)
        words = words_of(table["text"])
        one, two = _word_names(words)
        names, lengths = _symbols(one, words.first, rounds)
        _, inverse, counts = np.unique(names, return_inverse=True, return_counts=True)
        # A run longer than a window repeats it inside itself.
        known = (counts[inverse] > 1) | (lengths > window) | np.isin(names, _flat(shared["names"], np.int64).view(np.uint64))
        lone = np.concatenate([[0], np.cumsum(np.repeat((lengths >= least) & ~known, lengths))])
        for_each = np.maximum(np.diff(words.first) - window + 1, 0)
        begin = np.repeat(words.first[:-1], for_each)
        fits = begin + np.arange(len(begin)) - np.repeat(np.cumsum(for_each) - for_each, for_each)
        keys = table["_key"].to_numpy()
        copied = np.isin(table["_id"].to_numpy(), _flat(shared["copies"], np.int64))
        copied_window = np.repeat(copied, for_each)
        may = ~copied_window & (lone[fits + window - inner] == lone[fits + inner])
        place = fits[may]
        high = _window_hashes(one, window, 1)[place]
        low = (_window_hashes(two, window, 2)[place] >> np.uint64(32)).astype(np.uint32)
        order = np.lexsort((place, low, high))
        h, w = high[order], low[order]
        again = np.zeros(len(order), bool)
        again[1:] = (h[1:] == h[:-1]) & (w[1:] == w[:-1])
        certain = np.concatenate([place[order[again]], fits[copied_window]])
        order = order[~again]
        high, low, place = high[order], low[order], place[order]
        document = keys[np.searchsorted(words.first, place, "right") - 1]
        order, found, ends = _by_group((high % np.uint64(targets)).astype(np.int32))
        own = table["bucket"][0].as_py()
        certain.sort()
        # Known windows need no comparison: they go to the target numbered like their own bucket,
        # in a line of their own, so each target gets those of one bucket.
        home = int(len(certain) > 0)
        found, ends = np.append(found, np.full(home, own)).astype(np.int32), np.append(ends, np.full(home, len(order))).astype(np.int64)
        sent = np.zeros(len(found), np.int64)
        sent[len(found) - home :] = len(certain)
        return pa.table(
            {
                "target": pa.array(found, pa.int32()),
                "bucket": np.full(len(found), own, np.int32),
                "high": _lists(high[order].view(np.int64), ends, pa.int64()),
                "low": _lists(low[order].view(np.int32), ends, pa.int32()),
                "doc": _lists(document[order], ends, pa.int64()),
                "place": _lists(place[order], ends, pa.int32()),
                "known": _lists(certain, sent, pa.int32()),
            }
        )

    return run


T_EMPTY_WINDOWS = pa.table(
    {
        "target": pa.array([], pa.int32()),
        "bucket": pa.array([], pa.int32()),
        "high": pa.array([], pa.list_(pa.int64())),
        "low": pa.array([], pa.list_(pa.int32())),
        "doc": pa.array([], pa.list_(pa.int64())),
        "place": pa.array([], pa.list_(pa.int32())),
        "known": pa.array([], pa.list_(pa.int32())),
    }
)


def _later_places(table: pa.Table) -> pa.Table:
    """By bucket, the places of windows that start earlier elsewhere."""
    high, low = _flat(table["high"], np.int64), _flat(table["low"], np.int32)
    document, place = _flat(table["doc"], np.int64), _flat(table["place"], np.int32)
    bucket = np.repeat(table["bucket"].to_numpy(), _lengths(table["high"]))
    order = np.lexsort((place, bucket, document, low, high))
    again = np.zeros(len(order), bool)
    again[1:] = (high[order[1:]] == high[order[:-1]]) & (low[order[1:]] == low[order[:-1]])
    later = order[again]
    places = np.concatenate([place[later], _flat(table["known"], np.int32)])
    buckets = np.concatenate([bucket[later], np.repeat(table["bucket"].to_numpy(), _lengths(table["known"]))])
    order, found, ends = _by_group(buckets)
    return pa.table({"bucket": pa.array(found, pa.int32()), "places": _lists(places[order], ends, pa.int32())})


def _finish(window: int, schema: pa.Schema, rows: Callable) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(table: pa.Table, repeats: pa.Table) -> pa.Table:
        if not table.num_rows:
            return schema.empty_table()
        table = _in_order(table)
        texts = [t.split() for t in pc.fill_null(table["text"].cast(pa.large_binary()), b"").to_pylist()]
        first = np.concatenate([[0], np.cumsum([len(t) for t in texts], dtype=np.int64)])
        change = np.zeros(first[-1] + 1, np.int64)
        places = _flat(repeats["places"], np.int64)
        np.add.at(change, places, 1)
        np.add.at(change, places + window, -1)
        keep = np.cumsum(change)[:-1] == 0
        kept, counts = [], []
        for d, words in enumerate(texts):
            mask = keep[first[d] : first[d + 1]]
            counts.append((len(words), len(words) - int(mask.sum())))
            kept.append(b" ".join(words if counts[-1][1] == 0 else itertools.compress(words, mask.tolist())))
        return rows(table, kept, counts)

    return run


def _repeats(docs: DataFrame, rows_once: DataFrame, carry: list[str], schema: str | T.StructType, arrow: pa.Schema, rows: Callable, window: int, rounds, least: int) -> DataFrame:
    """``rows(table, kept, counts)`` for every bucket of ``rows_once``: its rows, their kept words joined, and (words, removed words).

    ``rows_once`` holds each doc_id and text of ``docs``, but may leave out equal rows.
    """
    if window <= 2 * edge(rounds):
        raise ValueError(f"a window needs more than {2 * edge(rounds)} words for these rounds")
    size = docs.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long"))).first()[0] or 0
    buckets = max(1, math.ceil(size / BUCKET_BYTES))
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST))  # null ids stand last
    named = rows_once.select(*carry).withColumns({"_key": key, "_print": F.xxhash64("text")})
    named = named.withColumn("_id", F.xxhash64("_key", "_print"))
    named = named.withColumn("bucket", F.pmod("_id", F.lit(buckets)).cast("int"))
    by_bucket = named.groupBy("bucket")
    names = by_bucket.applyInArrow(_names_of(buckets, rounds, least), _NAMES)
    shared = names.groupBy("target").applyInArrow(_shared_names, _SHARED)
    # Documents whose whole text an earlier one has need no windows of their own.
    prints = docs.where("text is not null").select(key.alias("_key"), F.md5(F.col("text").cast("binary")).alias("_md5"), F.xxhash64("text").alias("_print"))
    earliest = prints.groupBy("_md5").agg(F.min("_key").alias("_earliest"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    # Written, so that both sides of the join come straight from a shuffle, which lets it split a hot text.
    copies = prints.join(pin(earliest.drop("_n")), "_md5").where("_key > _earliest")
    copies = copies.select(F.xxhash64("_key", "_print").alias("_id")).distinct().select(  # equal rows are one line
        F.pmod("_id", F.lit(buckets)).cast("int").alias("bucket"),
        F.lit(None).cast("array<bigint>").alias("names"),
        F.array("_id").alias("copies"),
    )
    told = shared.unionByName(copies).groupBy("bucket")
    windows = by_bucket.cogroup(told).applyInArrow(_windows_of(buckets, window, rounds, least), _WINDOWS)
    later = windows.groupBy("target").applyInArrow(_later_places, _REPEATS)
    return by_bucket.cogroup(later.groupBy("bucket")).applyInArrow(_finish(window, arrow, rows), schema)


def repeat_digests(docs: DataFrame, window: int = WINDOW, rounds: tuple[int, ...] = ROUNDS, least: int = LEAST) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by one space) of every row.

    A word goes if a window of ``window`` words over it also starts earlier: in a row with a
    smaller doc_id, or earlier in the same row.  Windows are judged on the input and never
    cross rows.  Null texts have no words; null ids stand after all others.  Rows that share
    an id count as parts of one document, in the order of a hash; of equal rows, the first is
    judged like any other and the rest lose all their words if they have a window.  An empty
    table gives no rows; only doc_id and text of ``docs`` are read.  A text of any length lies
    in one bucket.
    """
    columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    arrow = pa.schema(list(zip([*columns, "_times"], types)))
    nothing = hashlib.sha256(b"").hexdigest()

    def rows(table, kept, counts):
        digests = [hashlib.sha256(k).hexdigest() for k in kept]
        n = np.array(counts, np.int64).reshape(-1, 2)
        ids = table["doc_id"].cast(pa.int64()).combine_chunks()
        first = pa.table([ids, pa.array(n[:, 0]), pa.array(n[:, 1]), pa.array(digests), pa.array(np.ones(len(n), np.int64))], schema=arrow)
        more = table["_n"].to_numpy().astype(np.int64) - 1
        again = np.flatnonzero(more)
        words = n[again, 0]
        gone = np.where(words >= window, words, 0)
        late = [nothing if g else digests[i] for i, g in zip(again.tolist(), gone.tolist())]
        later = [ids.take(pa.array(again)), pa.array(words), pa.array(gone), pa.array(late, pa.string()), pa.array(more[again])]
        return pa.concat_tables([first, pa.table(later, schema=arrow)])

    # Texts are shuffled for the count only if some rows have equal hashes, as all equal rows do.
    # Partly counted in the map tasks: a repeated row sends one line from each of them.
    if docs.groupBy(F.xxhash64("doc_id", "text")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").isEmpty():
        once = docs.select("doc_id", "text", F.lit(1).cast("long").alias("_n"))
    else:
        once = docs.groupBy("doc_id", "text").agg(F.count(F.lit(1)).alias("_n"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, _times long"
    found = _repeats(docs, once, ["doc_id", "text", "_n"], schema, arrow, rows, window, rounds, least)
    runs = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_times") - 1, F.lit(_RUN).cast("long")))
    places = F.explode(F.sequence(F.col("_run"), F.least(F.col("_run") + _RUN, F.col("_times")) - 1))
    return found.withColumn("_run", runs).select(*columns, places.alias("_place")).select(*columns)


def drop_repeats(docs: DataFrame, window: int = WINDOW, rounds: tuple[int, ...] = ROUNDS, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` without repeated words, by the rule of ``repeat_digests``.

    A text that loses words becomes its kept words joined by one space, and n_chars, if there,
    its new length; other rows stay byte for byte.  A row whose words all go is dropped.
    Rows of equal id and text lie in one bucket here, so very many of them should go before.
    """
    own = {name: f"_c{i}" for i, name in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{n}`").alias(c) for n, c in own.items()], F.col("doc_id"), F.col("text"))
    fields = [T.StructField(c, docs.schema[n].dataType) for n, c in own.items()]
    schema = T.StructType(fields)
    arrow = to_arrow_schema(schema)

    def rows(table, kept, counts):
        n = np.array(counts, np.int64).reshape(-1, 2)
        changed = n[:, 1] > 0
        out = table.select(list(own.values()))
        stay = pa.array(~changed | (n[:, 1] < n[:, 0]))
        if changed.any():
            texts = pa.array([k.decode("utf-8") if c else None for k, c in zip(kept, changed)], pa.large_string())
            mask = pa.array(changed)
            for name, new in (("text", texts), ("n_chars", pc.utf8_length(texts))):
                if name in own:
                    at = out.schema.get_field_index(own[name])
                    old = out.column(at)
                    out = out.set_column(at, own[name], pc.if_else(mask, new.cast(old.type), old))
        return out.filter(stay).cast(arrow)

    found = _repeats(renamed, renamed, [*own.values(), "doc_id", "text"], schema, arrow, rows, window, rounds, least)
    return found.select(*[F.col(c).alias(n) for n, c in own.items()])
