"""Best-fit packing of token sequences by bin completion.

Documents become token ids, closed by an end id; only longer ones are cut, into pieces of the sequence
length, the last one shorter. What is packed is the histogram of piece lengths: it has at most as many
entries as a sequence has tokens, however many pieces there are, and pieces of one length can stand for
each other. The packing is a list of patterns (how many pieces of which lengths) with copies.

Best-fit decreasing gives the first incumbent. Where it uses more sequences than the lower bound, bin
completion searches for a better one: it takes the longest piece left, enumerates the undominated
fillings of the room beside it with the least waste first, uses a filling as often as the histogram
allows, and gives up a branch once its waste leaves no room for a better packing. The search ends at the
lower bound or after ``search_nodes`` fillings; the incumbent is whole at any time.

Pieces learn their place from their rank among the pieces of their length: a rank within the task that
cut them, plus the counts of the tasks before. So nothing but the histogram reaches the driver.

Null or empty texts are an end id alone. Equal rows are packed one by one; a null doc_id stays null.
An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from taperline.llm.common import stored
from taperline.llm.tokens import text_ids

CAPACITY = 4096
END_ID = 1
#: Bins that the search completes in all.
SEARCH_NODES = 4_000

Pattern = tuple[tuple[int, int], ...]
Packing = list[tuple[Pattern, int]]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The least number of sequences, by Martello and Toth's bound over all thresholds."""
    n = np.zeros(capacity + 2, dtype=np.int64)
    for length, count in counts.items():
        n[length] = count
    amount = n * np.arange(capacity + 2)
    below, mass = np.cumsum(n), np.cumsum(amount)
    half, best = capacity // 2, 0
    for k in range(1, half + 1):
        alone = below[capacity] - below[capacity - k]
        large, large_mass = below[capacity - k] - below[half], mass[capacity - k] - mass[half]
        small = mass[half] - mass[k - 1]
        rest = max(0, int(small - (large * capacity - large_mass)))
        best = max(best, int(alone + large) + -(-rest // capacity))
    return best


def merged(pattern: Pattern, length: int, count: int) -> Pattern:
    return (*pattern, (length, count))


def best_fit(counts: dict[int, int], capacity: int) -> Packing:
    """Best-fit decreasing on the histogram: equal bins move together."""
    open_: dict[int, list[list]] = {}  # room -> [pattern, copies]
    rooms: list[int] = []

    def put(room: int, pattern: Pattern, copies: int) -> None:
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append([pattern, copies])

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                group = open_[room][-1]
            else:
                room, group = capacity, [(), left]
            each = min(room // length, left)
            copies = min(group[1], left // each)
            if at < len(rooms):
                group[1] -= copies
                if not group[1]:
                    open_[room].pop()
                    if not open_[room]:
                        del open_[room]
                        rooms.pop(at)
            put(room - each * length, merged(group[0], length, each), copies)
            left -= each * copies
    return [(p, c) for groups in open_.values() for p, c in groups]


def reachable(room: int, lengths: list[int], left: dict[int, int]) -> list[int]:
    """For each k the sums up to ``room`` of pieces of the k shortest lengths, as the bits of a number."""
    inside, sums, out = (1 << (room + 1)) - 1, 1, [1]
    for length in lengths:
        # Binary parts of the count: any number of pieces from none to all of them.
        count, part = min(left[length], room // length), 1
        while count:
            part = min(part, count)
            sums |= (sums << (part * length)) & inside
            count -= part
            part *= 2
        out.append(sums)
    return out


def fillings(room: int, lengths: list[int], left: dict[int, int], most_waste: int) -> Iterator[tuple[int, Pattern]]:
    """(waste, pattern) of the undominated ways to fill ``room`` from rising ``lengths``: least waste first, then longest pieces.

    A filling is dominated if a piece that is left over fits into its gap, alone or in place of a shorter one.
    The reachable sums lead straight to fillings, so none is sought in vain.
    """
    lengths = lengths[: bisect_right(lengths, room)]
    sums = reachable(room, lengths, left)

    used = dict.fromkeys(lengths, 0)

    def dominated(i: int, waste: int) -> bool:
        """Whether a piece left over could stand in place of one of the i-th length."""
        for longer in islice(lengths, i + 1, None):
            if longer - lengths[i] > waste:
                return False
            if left[longer] > used[longer]:
                return True
        return False

    def exact(amount: int, k: int, waste: int) -> Iterator[Pattern]:
        """Undominated patterns of the k shortest lengths that sum to ``amount``."""
        if not amount:
            if not any(left[x] > used[x] for x in lengths[: bisect_right(lengths, waste)]):
                yield ()
            return
        # The longest piece is one that shorter ones complete.
        for i in range(bisect_right(lengths, amount, 0, k) - 1, -1, -1):
            if not sums[i + 1] >> amount & 1:
                return
            length = lengths[i]
            if waste and dominated(i, waste):
                continue
            for count in range(min(left[length], amount // length), 0, -1):
                if sums[i] >> (amount - count * length) & 1:
                    used[length] = count
                    for rest in exact(amount - count * length, i, waste):
                        yield ((length, count), *rest)
            used[length] = 0

    try:
        for waste in range(min(room, most_waste) + 1):
            if sums[-1] >> (room - waste) & 1:
                for pattern in exact(room - waste, len(lengths), waste):
                    yield waste, pattern
    finally:
        del exact  # it refers to itself, and would keep the sums until the next collection


def longest_first(left: dict[int, int], capacity: int, bins: int) -> Packing:
    """Up to ``bins`` bins, each of the longest pieces that fit; they are taken out of ``left``."""
    out: Packing = []
    while left and bins:
        room, pattern = capacity, []
        for length in sorted(left, reverse=True):
            count = min(left[length], room // length)
            if count:
                pattern.append((length, count))
                room -= count * length
        copies = min(bins, *(left[length] // n for length, n in pattern))
        for length, n in pattern:
            left[length] -= copies * n
            if not left[length]:
                del left[length]
        out.append((tuple(pattern), copies))
        bins -= copies
    return out


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, search_nodes: int = SEARCH_NODES) -> Packing:
    """As few bins as the search finds; optimal where it reaches the lower bound or tries every branch.

    First come single descents that try one filling for each longest piece: the one of least waste
    throughout, then after some bins of long pieces alone, whose share is sought by halving (long pieces may
    use up the short ones that others need). What is left of the nodes goes into passes that try one, two,
    four and so on fillings, with backtracking.
    """
    best = best_fit(counts, capacity)
    least, size = lower_bound(counts, capacity), sum(c for _, c in best)
    nodes, width = 0, 1
    tried: dict[int, int] = {}

    def descend(first: int) -> None:
        nonlocal best, size, nodes
        if first in tried or size <= least or nodes >= search_nodes:
            return
        left = dict(counts)
        bins = longest_first(left, capacity, first)
        opened = sum(c for _, c in bins)
        found, used, _ = search(left, capacity, 1 + sum(counts.values()), least - opened, 1, search_nodes - nodes)
        nodes += used
        tried[first] = opened + sum(c for _, c in found) if found is not None else size
        if found is not None and tried[first] < size:
            best, size = [*bins, *found], tried[first]

    descend(0)
    step = size // 8
    for first in range(step, size // 2 + 1, max(1, step)):
        descend(first)
    while step > 1 and size > least and nodes < search_nodes:
        step //= 2
        centre = min(tried, key=lambda k: (tried[k], k))
        descend(max(0, centre - step))
        descend(centre + step)
    while size > least and nodes < search_nodes:
        found, used, whole = search(counts, capacity, size, least, width, (search_nodes - nodes + 1) // 2)
        nodes += used
        if found:
            best, size = found, sum(c for _, c in found)
        if whole:
            break
        width *= 2
    return best


def search(counts: dict[int, int], capacity: int, size: int, least: int, width: int, most_nodes: int) -> tuple[Packing | None, int, bool]:
    """(a packing of fewer than ``size`` bins if found, nodes, whether no branch was left out), depth first on one histogram."""
    total = sum(length * n for length, n in counts.items())
    left, nodes, whole = dict(counts), 0, True
    best: Packing | None = None
    # A frame is (options to try, waste before, (bin, copies) taken or None).
    stack: list[list] = []

    def options(waste: int) -> Iterator[tuple[Pattern, int, int]]:
        """(bin, copies, waste) around the longest piece that is left."""
        nonlocal whole
        longest = max(left)
        left[longest] -= 1
        spare = (size - 1) * capacity - total - waste
        # The lengths are not kept: there is a frame for each bin of a branch.
        around = fillings(capacity - longest, sorted(x for x, n in left.items() if n), left, spare)
        tried = list(islice(around, width + 1))
        around.close()
        del around
        left[longest] += 1
        whole = whole and len(tried) <= width
        for gap, filling in tried[:width]:
            need = dict(filling)
            need[longest] = need.get(longest, 0) + 1
            copies = min(left[length] // n for length, n in need.items())
            copies = min(copies, spare // gap) if gap else copies
            pattern = tuple(sorted(need.items(), reverse=True))
            # As often as possible, then fewer times; all numbers of copies would be needed to be sure.
            fewer = sorted({copies, *(copies >> k for k in range(1, width.bit_length()))} - {0}, reverse=True)
            whole = whole and len(fewer) == copies
            for n in fewer:
                yield pattern, n, gap * n

    if not left:
        return [], nodes, whole
    stack.append([options(0), 0, None])
    alone = width == 1 and size > sum(counts.values())  # any packing will do: the first one is taken
    while stack and nodes < most_nodes and size > least:
        branch, waste, taken = stack[-1]
        if taken:  # back from below: put the pieces back
            for length, n in taken[0]:
                left[length] = left.get(length, 0) + n * taken[1]
            stack[-1][2] = None
        option = next(branch, None)
        if option is None:
            stack.pop()
            continue
        nodes += 1
        pattern, copies, wasted = option
        if waste + wasted > (size - 1) * capacity - total:
            continue
        for length, n in pattern:
            left[length] -= copies * n
            if not left[length]:
                del left[length]
        stack[-1][2] = (pattern, copies)
        if left:
            stack.append([options(waste + wasted), waste + wasted, None])
            continue
        best = [frame[2] for frame in stack]
        size = sum(c for _, c in best)
        if alone:
            break
    return best, nodes, whole and not stack


def cut_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, shard, place (and ids)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = text_ids(tokenizer_path).ids
        end = END_ID.to_bytes(4, "little")
        shard = TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, dtype=np.int64)
        for batch in batches:
            owner, number, start, length, crc, place, ids = [], [], [], [], [], [], []
            for row, text in enumerate(batch.column(1)):
                whole = (encode(text.as_py().encode()) if text.is_valid else b"") + end
                for i, at in enumerate(range(0, len(whole), 4 * capacity)):
                    piece = whole[at : at + 4 * capacity]
                    size = len(piece) // 4
                    owner.append(row)
                    number.append(i)
                    start.append(at // 4)
                    length.append(size)
                    crc.append(zlib.crc32(piece))
                    place.append(seen[size])
                    seen[size] += 1
                    if with_ids:
                        ids.append(np.frombuffer(piece, dtype="<u4").astype(np.int64))
            columns = [
                batch.column(0).take(pa.array(owner, pa.int64())),
                pa.array(number, pa.int32()),
                *(pa.array(x, pa.int64()) for x in (start, length, crc)),
                pa.array([shard] * len(owner), pa.int32()),
                pa.array(place, pa.int64()),
            ]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "shard", "place"]
            if with_ids:
                columns, names = [*columns, pa.array(ids, pa.list_(pa.int64()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, shard int, place long"
    return documents.select("doc_id", "text").mapInArrow(run, schema + ", ids array<long>" * with_ids)


def places(packing: Packing) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence, pieces per sequence and offset of each pattern that holds it."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    taken: dict[int, int] = {}
    sequence = 0
    for pattern, copies in packing:
        offset = 0
        for length, count in pattern:
            rows.setdefault(length, []).append((taken.get(length, 0), sequence, count, offset))
            taken[length] = taken.get(length, 0) + copies * count
            offset += length * count
        sequence += copies
    return {length: tuple(np.array(r, dtype=np.int64).T) for length, r in rows.items()}


def packed(pieces: DataFrame, capacity: int = CAPACITY, search_nodes: int = SEARCH_NODES) -> DataFrame:
    """Add sequence_id and offset to stored pieces."""
    per_shard = stored(pieces.groupBy("shard", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = {r["length"]: r["n"] for r in per_shard.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = places(complete_bins(histogram, capacity, search_nodes))
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    # One row per task and length: the counts of the tasks before.
    before = W.partitionBy("length").orderBy("shard").rowsBetween(W.unboundedPreceding, -1)
    earlier = per_shard.select("shard", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    extra = ["ids"] if "ids" in pieces.columns else []
    ranked = pieces.join(earlier, ["shard", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("place") + F.col("earlier")).alias("rank"), *extra
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            sequence, offset = np.zeros(len(rank), dtype=np.int64), np.zeros(len(rank), dtype=np.int64)
            order = np.argsort(length, kind="stable")
            values, starts = np.unique(length[order], return_index=True)
            for value, at in zip(values, np.split(order, starts[1:]), strict=bool(len(values))):
                first, base, each, shift = shared.value[int(value)]
                row = np.searchsorted(first, rank[at], side="right") - 1
                k = rank[at] - first[row]
                sequence[at] = base[row] + k // each[row]
                offset[at] = shift[row] + k % each[row] * value
            columns = [*(batch.column(i) for i in range(5)), pa.array(sequence), pa.array(offset), *batch.columns[6:]]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *extra]
            yield pa.RecordBatch.from_arrays(columns, names)

    types = {f.name: f.dataType.simpleString() for f in ranked.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in ("doc_id", "piece", "start", "length", "ids_crc32"))
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long" + ", ids array<long>" * len(extra))


def pack_documents(documents: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Every piece of every document with its place in the packed sequences."""
    return packed(stored(cut_documents(documents, tokenizer_path, capacity, with_ids), "pieces"), capacity)
