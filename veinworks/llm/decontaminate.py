"""Benchmark decontamination by q-gram lemma filtering and banded alignment.

A passage within ``k`` edits of a benchmark item of ``m`` characters shares at
least ``m - q + 1 - k * q`` of the item's q-grams with it, all within ``k + 1``
neighbouring diagonals (position in the text minus position in the item). So
the shared q-grams of a text are counted in overlapping bands of diagonals, and
only regions that meet the bound are aligned, within the band.

Letters A-Z count as a-z and white space as a space, character by character, so
positions are those of the text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from veinworks.llm.base import map_arrow, query, table, texts

Q = 12
EDITS = 0.05
BASE = np.uint64(0x9E3779B97F4A7C15)
SLOTS = 22  # bits of the first look-up
LOT_CHARS = 2 << 20
LAID_OUT = 1 << 20  # hits in memory at once
BLOCK_CHARS = 1 << 20  # code points of items that a task holds at once: bounds what is sent to it
SPACES = np.array([9, 10, 11, 12, 13, 32, 0x85, 0xA0])
WALL = 0xFFFFFFFF  # between texts; no character


def codes(text: str) -> np.ndarray:
    """Code points, folded one by one."""
    out = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").copy()
    out[(out >= 65) & (out <= 90)] += 32
    out[(out <= 0xA0) & np.isin(out, SPACES)] = 32
    return out


def gram_hashes(chars: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q characters from each position, by doubling."""
    if len(chars) < q:
        return np.zeros(0, np.uint64)
    power, width, have = chars.astype(np.uint64) + np.uint64(1), 1, None
    factor, at = BASE, 0
    n = len(chars) - q + 1
    while True:
        if q & width:  # blocks of the binary expansion of q, one after another
            block = power[at : at + n]
            have = block if have is None else have * factor + block
            at += width
        if 2 * width > q:
            break
        power = power[:-width] * factor + power[width:]
        factor, width = np.uint64(int(factor) ** 2 % (1 << 64)), 2 * width
    have ^= have >> np.uint64(29)
    return have * np.uint64(0xBF58476D1CE4E5B9)


@dataclass
class Items:
    """Benchmark items of a block with their q-grams, sorted by hash."""

    ids: list
    chars: list[np.ndarray]
    edits: np.ndarray
    needed: np.ndarray
    hashes: np.ndarray
    owner: np.ndarray
    offset: np.ndarray
    slots: np.ndarray

    @classmethod
    def build(cls, rows: list[tuple], q: int, rate: float) -> "Items":
        chars = [codes(text or "") for _, text in rows]
        size = np.array([len(c) for c in chars], np.int64)
        # As many edits as the rate allows and the lemma can still tell: the bound stays above zero.
        edits = np.maximum(0, np.minimum((rate * size).astype(np.int64), (size - q) // q))
        grams = [gram_hashes(c, q) for c in chars]
        owner = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
        offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint64)
        order = np.argsort(hashes, kind="stable")
        slots = np.zeros(1 << SLOTS, bool)
        slots[hashes >> np.uint64(64 - SLOTS)] = True
        return cls([r[0] for r in rows], chars, edits, size - q + 1 - edits * q, hashes[order], owner[order], offset[order].astype(np.int64), slots)


def banded_distance(item: np.ndarray, text: np.ndarray, diagonal: int, width: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best passage of ``text`` for the whole ``item``, if at most ``most`` edits.

    Only cells whose diagonal lies in ``width`` diagonals from ``diagonal`` are
    computed. Of equally good passages the first to end counts, the shortest.
    """
    lanes = np.arange(width)
    at = diagonal + lanes  # text position before the first row, by lane
    huge = most + 1 + len(item) + width
    cost = np.where((at >= 0) & (at <= len(text)), 0, huge)
    begin = at.copy()
    for i, c in enumerate(item):
        place = at + i  # text character that the lane reads in this row
        inside = (place >= 0) & (place < len(text))
        same = np.zeros(width, bool)
        same[inside] = text[place[inside]] == c
        step = np.where(inside, cost + ~same, huge)
        came = begin.copy()
        # An item character left out: from the lane above, which stands one text position further on.
        drop = np.append(cost[1:] + 1, huge)
        drop[(place + 1 < 0) | (place + 1 > len(text))] = huge
        better = drop < step
        step[better], came[better] = drop[better], np.append(begin[1:], 0)[better]
        # Text characters put in: a running minimum along the lanes.
        ramp = step - lanes
        low = np.minimum.accumulate(ramp)
        source = np.maximum.accumulate(np.where(ramp == low, lanes, 0))
        ends = (place + 1 >= 0) & (place + 1 <= len(text))
        cost, begin = np.where(ends, low + lanes, huge), came[source]
        if cost.min() > most:
            return None
    lane = int(np.argmin(cost))
    return int(cost[lane]), int(begin[lane]), int(at[lane] + len(item))


def _equal(item: np.ndarray, text: np.ndarray, diagonal: int, width: int) -> tuple[int, int, int] | None:
    """The item as it is in the text, from one of the diagonals."""
    low = max(0, diagonal)
    data, wanted = text[low : max(0, diagonal + width + len(item))].tobytes(), item.tobytes()
    at = data.find(wanted)
    while at >= 0 and at % 4:
        at = data.find(wanted, at + 1)
    return None if at < 0 else (0, low + at // 4, low + at // 4 + len(item))


def matches(lot: list[str], items: Items, q: int) -> list[tuple[int, int, int, int, int]]:
    """(text number, item number, edits, start, end): the best passage of each item in each text."""
    parts = [codes(t) for t in lot]
    sizes = np.array([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], np.cumsum(sizes)])
    joined = np.full(starts[-1], WALL, np.uint32)
    for p, s in zip(parts, starts, strict=False):
        joined[s : s + len(p)] = p
    found = gram_hashes(joined, q)
    position = np.flatnonzero(items.slots[found >> np.uint64(64 - SLOTS)])
    low = np.searchsorted(items.hashes, found[position])
    count = np.searchsorted(items.hashes, found[position], side="right") - low
    position, low, count = position[count > 0], low[count > 0], count[count > 0]
    if not len(position):
        return []
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    owner_text = np.searchsorted(starts, position, side="right") - 1

    def align(rows) -> None:
        for t, i, b in rows:
            done = best.get((t, i))
            if done and done[0] == 0:
                continue
            k, item = int(items.edits[i]), items.chars[i]
            first, width = b * (k + 1) - int(starts[t]) - k, 4 * k + 2
            got = _equal(item, parts[t], first, width) or banded_distance(item, parts[t], first, width, done[0] if done else k)
            if got and (done is None or got < done):
                best[t, i] = got

    # A common q-gram has many places in the items: hits are laid out a bounded number at a time, text by
    # text, and a text that has more than that (a run of dashes) is counted without laying them out.
    crowded = np.bincount(owner_text, count, minlength=len(parts)) > LAID_OUT
    alone = crowded[owner_text]
    for t in np.flatnonzero(crowded).tolist():
        of = slice(*np.searchsorted(owner_text, [t, t + 1]))
        align((t, i, b) for i, b in crowded_bands(position[of], low[of], count[of], items, int(starts[t]), len(parts[t])))
    position, low, count, owner_text = position[~alone], low[~alone], count[~alone], owner_text[~alone]
    total = np.cumsum(count)
    begin = 0
    while begin < len(position):
        reach = int(np.searchsorted(total, (total[begin - 1] if begin else 0) + LAID_OUT))
        end = int(np.searchsorted(owner_text, owner_text[min(max(reach, begin), len(position) - 1)], side="right"))
        part = slice(begin, end)
        begin = end
        n = count[part]
        slot = _ranges(low[part], n)
        item, text = items.owner[slot], np.repeat(owner_text[part], n)
        diagonal = np.repeat(position[part], n) - items.offset[slot]
        step = items.edits[item] + 1
        band = diagonal // step
        # Bands are two steps wide and start at each step, so k + 1 neighbouring diagonals share one.
        rows = np.stack([np.tile(text, 2), np.tile(item, 2), np.concatenate([band, band - 1])], axis=1)
        key = np.lexsort(rows.T[::-1])
        rows = rows[key]
        cuts = np.flatnonzero(np.concatenate([[True], (rows[1:] != rows[:-1]).any(1)]))
        shared = np.diff(np.concatenate([cuts, [len(rows)]]))
        align(rows[cuts][shared >= items.needed[rows[cuts, 1]]].tolist())
    return [(t, i, *v) for (t, i), v in sorted(best.items())]


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start, start + 1, ... (n of them), one range after another."""
    return np.repeat(start - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())


def crowded_bands(position: np.ndarray, low: np.ndarray, count: np.ndarray, items: Items, start: int, size: int):
    """(item number, band) of one text, from where the text's q-grams are and where the items have the same ones.

    The same bands as hit by hit, item by item in counts by band: a q-gram with
    very many hits in an item adds the cross-correlation of its places.
    """
    first, gram = np.unique(low, return_index=True, return_inverse=True)[1:]
    places = position[np.argsort(gram, kind="stable")]
    times = np.bincount(gram)
    place_at = np.concatenate([[0], np.cumsum(times)])
    slot = _ranges(low[first], count[first])  # at most all q-grams of the block
    slot_gram = np.repeat(np.arange(len(first)), count[first])
    order = np.argsort(items.owner[slot], kind="stable")
    slot, slot_gram = slot[order], slot_gram[order]
    owner = items.owner[slot]
    for i in np.unique(owner).tolist():
        of = slice(*np.searchsorted(owner, [i, i + 1]))
        offset, of_gram = items.offset[slot[of]], slot_gram[of]
        step, length = int(items.edits[i]) + 1, len(items.chars[i])
        lowest = (start - length) // step - 1
        bands = np.zeros((start + size) // step - lowest + 2, np.int64)
        hits = np.bincount(of_gram) * times[: of_gram.max() + 1]
        for g in np.flatnonzero(hits > LAID_OUT).tolist():
            found = diagonal_counts(places[place_at[g] : place_at[g + 1]] - start, offset[of_gram == g], size, length)
            band = (np.arange(len(found)) + start - length + 1) // step - lowest
            bands += np.bincount(band, found, minlength=len(bands)).astype(np.int64)
        few = hits[of_gram] <= LAID_OUT
        offset, of_gram = offset[few], of_gram[few]
        laid = np.cumsum(times[of_gram])
        begin = 0
        while begin < len(offset):
            end = max(begin + 1, int(np.searchsorted(laid, (laid[begin - 1] if begin else 0) + LAID_OUT, side="right")))
            g = of_gram[begin:end]
            diagonal = places[_ranges(place_at[g], times[g])] - np.repeat(offset[begin:end], times[g])
            bands += np.bincount(diagonal // step - lowest, minlength=len(bands))
            begin = end
        shared = bands + np.append(bands[1:], 0)
        yield from ((i, int(b) + lowest) for b in np.flatnonzero(shared >= items.needed[i]))


def diagonal_counts(position: np.ndarray, offset: np.ndarray, size: int, length: int) -> np.ndarray:
    """How many pairs have each difference position - offset, from ``1 - length`` up.

    Cross-correlation by Fourier transforms over blocks of the text; counts are
    whole numbers far below the rounding of doubles.
    """
    out = np.zeros(size + length, np.int64)
    block = max(LAID_OUT, length)
    width = 1 << int(block + length).bit_length()
    mirror = np.zeros(width)
    mirror[length - 1 - offset] = 1
    mirror = np.fft.rfft(mirror)
    for begin in range(0, size, block):
        inside = position[slice(*np.searchsorted(position, [begin, begin + block]))] - begin
        if len(inside):
            here = np.zeros(width)
            here[inside] = 1
            found = np.rint(np.fft.irfft(np.fft.rfft(here) * mirror, width)).astype(np.int64)
            end = min(len(out), begin + block + length - 1)
            out[begin:end] += found[: end - begin]
    return out


def short_matches(lot: list[str], short: list[tuple[int, str]]) -> list[tuple[int, int, int, int, int]]:
    """Exact first occurrences, as whole words, of items too short for a q-gram."""
    import ahocorasick

    machine = ahocorasick.Automaton()
    for k, text in short:
        machine.add_word(text, (len(text), (*(machine.get(text, (0, ()))[1]), k)))
    machine.make_automaton()
    out: dict[tuple[int, int], tuple[int, int, int]] = {}
    for t, text in enumerate(lot):
        folded = codes(text).tobytes().decode("utf-32-le", "surrogatepass")
        for last, (size, owners) in machine.iter(folded):
            start, end = last + 1 - size, last + 1
            if folded[start - 1 : start].isalnum() and folded[start].isalnum():
                continue
            if folded[end : end + 1].isalnum() and folded[last].isalnum():
                continue
            for k in owners:
                out.setdefault((t, k), (0, start, end))
    return [(t, k, *v) for (t, k), v in out.items()]


def lots(batches, at: int):
    """(slice of a batch, its texts), each of about ``LOT_CHARS`` code points."""
    for batch in batches:
        start, lot, chars = 0, [], 0
        for k, text in enumerate(texts(batch.column(at)), 1):
            lot.append(text)
            chars += len(text)
            if chars >= LOT_CHARS or k == batch.num_rows:
                yield batch.slice(start, k - start), lot
                start, lot, chars = k, [], 0


def blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> list[list[tuple]]:
    """The items, in blocks small enough to go to every task. Items without text are left out."""
    rows = benchmark.select("item_id", "text").where(F.length("text") > 0)
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-chars // block_chars))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
    return [[tuple(r) for r in rows.where(part == k).orderBy("item_id", "text").collect()] for k in range(n)]


def _finder(rows: list[tuple], q: int, rate: float):
    """A function that gives the matches of a lot with the items of a block, built once per task."""
    ready: list = []

    def find(lot: list[str]) -> list[tuple[int, int, int, int, int]]:
        if not ready:
            folded = [codes(text).tobytes().decode("utf-32-le", "surrogatepass") for _, text in rows]
            ready.extend([Items.build(rows, q, rate), [(k, t) for k, t in enumerate(folded) if len(t) < q]])
        items, short = ready
        return sorted(matches(lot, items, q) + (short_matches(lot, short) if short else []))

    return find


def find_passages(
    docs: DataFrame, benchmark: DataFrame, rate: float = EDITS, q: int = Q, id_col: str = "doc_id", text_col: str = "text",
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """(doc_id, item_id, edits, start, end): the best passage for each item in each text that has one.

    A passage matches an item with at most ``rate`` edits per character of it
    (never so many that the q-gram bound tells nothing). Items shorter than
    ``q`` match as they are, as whole words. Null texts and items match
    nothing; rows that repeat an id are looked at one by one. ``benchmark`` goes
    to the tasks in blocks of bounded size, each a pass over ``docs``.
    """
    item_kind = benchmark.schema["item_id"].dataType
    schema = StructType([*docs.select(F.col(id_col).alias("doc_id")).schema.fields]).add("item_id", item_kind)
    schema = StructType([*schema.fields, *StructType.fromDDL("edits int, start int, end int").fields])
    chosen = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    arrow = [pa.int64() if item_kind.simpleString() == "bigint" else pa.string() if item_kind.simpleString() == "string" else None]

    def passages(rows: list[tuple]):
        find = _finder(rows, q, rate)

        def run(batches):
            for part, lot in lots(batches, 1):
                found = find(lot)
                if found:
                    t, i, edits, start, end = zip(*found, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(t)), pa.array([rows[k][0] for k in i], arrow[0]),
                         pa.array(edits, pa.int32()), pa.array(start, pa.int32()), pa.array(end, pa.int32())],
                        schema.fieldNames(),
                    )

        return run

    out = None
    for rows in blocks(benchmark, block_chars):
        part = map_arrow(chosen, passages(rows), schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, rate: float = EDITS, q: int = Q, text_col: str = "text", block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """The rows of ``docs`` whose text holds no passage of a benchmark item, with all their columns."""
    at = docs.columns.index(text_col)

    def clean(rows: list[tuple]):
        find = _finder(rows, q, rate)

        def run(batches):
            for part, lot in lots(batches, at):
                bad = {t for t, *_ in find(lot)}
                yield part.take(pa.array([k for k in range(part.num_rows) if k not in bad], pa.int64())) if bad else part

        return run

    for rows in blocks(benchmark, block_chars):
        docs = map_arrow(docs, clean(rows), docs.schema)
    return docs


@query("op8_decontamination")
def op8(spark, sf_dir):
    """Benchmark passages in all documents: document, item, edits and place."""
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
