"""Best-fit packing of tokenised documents into sequences of a fixed length.

Bulk-synchronous best fit. Documents are range-sorted by length; a document stands for its
rank within its length, so all documents of one length form a class and all gaps of one size
form another, at most ``size`` of each. Sweeps go through the lengths from long to short: the
class takes its successor, the smallest gap that holds it; as many documents as there are such
gaps win, by rank; the gaps shrink; those left over sweep again, and open sequences when no gap
holds them. The sweeps work on counts (a table with a proven bound of ``size`` rows); the ranks
are found by a range-partitioned sort, and each document reads its place from the table of
matches. No document, gap or id list passes through the driver.

Documents longer than a sequence are cut; full pieces fill a sequence alone, the first piece
may be shorter and is packed like a document.

Defined cases: a null or empty text is the end id alone, one token long; repeated rows and keys
are packed each; ties in length are ordered by key, start and checksum; an empty table gives no
rows; other columns of the input are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.tokens import piece_table
from linkloom.operators.ordered import running_total
from linkloom.scratch import stage

SIZE = 2048


def best_fit(counts: dict[int, int], size: int) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Matches of length classes to sequences, and the number of sequences.

    A match (length, low, high, sequence, offset) puts the documents of that length with rank
    ``low`` to ``high - 1`` at ``offset`` of the sequences from ``sequence`` on, one each.
    """
    matches: list[tuple[int, int, int, int, int]] = []
    ranges: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, how many)
    gaps: list[int] = []
    opened = 0

    def add(gap: int, first: int, many: int) -> None:
        if gap and many:
            if gap not in ranges:
                insort(gaps, gap)
            ranges[gap].append((first, many))

    for length in sorted(counts, reverse=True):
        rank, left = 0, counts[length]
        while left:
            at = bisect_left(gaps, length)
            if at < len(gaps):
                gap = gaps[at]
                first, many = ranges[gap].pop()
                if not ranges[gap]:
                    del ranges[gap]
                    gaps.pop(at)
                won = min(left, many)
                matches.append((length, rank, rank + won, first, size - gap))
                add(gap - length, first, won)
                add(gap, first + won, many - won)
                rank, left = rank + won, left - won
                continue
            room = size // length
            for slots, many in ((room, left // room), (left % room, 1)):
                if slots and many:
                    for k in range(slots):
                        matches.append((length, rank, rank + many, opened, k * length))
                        rank += many
                    add(size - slots * length, opened, many)
                    opened += many
            left = 0
    return matches, opened


def pack_pieces(pieces: DataFrame, size: int = SIZE, key: str = "doc_id") -> DataFrame:
    """``pieces`` (key, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``."""
    parts = pieces.filter(F.col("length") < size)
    classes = parts.groupBy("length").count().collect()  # one row a length, below ``size`` of them
    matches, opened = best_fit({r["length"]: r["count"] for r in classes}, size)
    plan = pieces.sparkSession.createDataFrame(
        matches, "length long, low long, high long, first long, offset long"
    )
    ranked = running_total(parts, ["length"], [key, "start", "ids_crc32"], F.lit(1), "rank")
    placed = ranked.join(F.broadcast(plan), "length").filter(
        (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    )
    columns = [key, "piece", "start", "length", "ids_crc32"]
    placed = placed.select(
        *columns, (F.col("first") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"
    )
    alone = pieces.filter(F.col("length") == size).select(
        *columns,
        (F.lit(opened) + F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return placed.unionByName(alone)


def pack(
    docs: DataFrame, file: str, size: int = SIZE, key: str = "doc_id", text: str = "text",
    ranks: str | None = None,
) -> DataFrame:
    """Tokenise ``docs`` once, into a written table of pieces, and pack them.

    ``ranks`` is a rank file of the vocabulary in ``file``; with it new words are merged faster.
    """
    pieces = piece_table(docs, file, size, key=key, text=text, ranks=ranks)
    return pack_pieces(stage(pieces, "pieces"), size, key)
