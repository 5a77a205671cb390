"""Sums over the bases of aligned reads, a batch of reads at once as arrays.

A batch holds pieces of reads on the reference (``pileup.read_pieces``). Its bases are laid out one after another, summed
per locus or cell, and leave as one row for each, which Spark adds up; no base becomes a row.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ..functions import arrays

#: bases laid out at once
AT_ONCE = 1 << 20
#: a dense table may have so many places for each base laid out
SPARSE = 4


class Bases:
    """Bases of some rows of a batch: ``row``, ``i`` (read offset), ``pos``, and letters as bytes, 0 where there is none."""

    def __init__(self, batch: pa.RecordBatch, rows: np.ndarray, held: dict):
        low, high, gone = (held[c][rows] for c in ("_lo", "_hi", "_gone"))
        n = high - low + 1
        total, begin = int(n.sum()), np.cumsum(n) - n
        self.row = np.repeat(rows, n)
        k = np.arange(total) + np.repeat(low - begin, n)
        self.pos = k + np.repeat(held["_p0"][rows], n)
        self.gone = np.repeat(gone, n)
        self.i = k * ~self.gone + np.repeat(held["_i0"][rows], n)
        self.ref = _letter(held["ref_seq"], self.row, k + np.repeat(held["_r0"][rows] - 1, n))
        self.base = np.where(self.gone, np.uint8(ord("*")), _letter(held["seq"], self.row, self.i))
        data, starts = held["quals"]
        at = starts[self.row] + self.i
        has = (at < starts[self.row + 1]) & (self.i >= 0) & ~self.gone
        self.q = np.full(total, -1 << 31)
        self.q[has] = data[at[has]]
        self.unknown = self.q == -1 << 31

    def keep(self, which: np.ndarray) -> None:
        for name, values in vars(self).items():
            setattr(self, name, values[which])


def _letter(text: tuple[np.ndarray, np.ndarray], row: np.ndarray, at: np.ndarray) -> np.ndarray:
    data, starts = text
    place = starts[row] + at
    inside = (at >= 0) & (place < starts[row + 1])
    out = np.zeros(len(row), np.uint8)
    out[inside] = data[place[inside]]
    return out


def laid_out(batch: pa.RecordBatch, at_once: int = AT_ONCE):
    """``Bases`` of the batch, about ``at_once`` at a time."""
    held = {c: arrays.numbers(batch[c]) for c in ("_lo", "_hi", "_p0", "_i0", "_r0")}
    held["_gone"] = arrays.numbers(batch["_step"]) == 0
    held |= {c: arrays.ascii_letters(batch[c]) for c in ("ref_seq", "seq")} | {"quals": arrays.lists(batch["quals"], -1 << 31)}
    part = np.cumsum(held["_hi"] - held["_lo"] + 1) // at_once
    for rows in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1):
        if len(rows):
            yield Bases(batch, rows, held)


def grouped(batch: pa.RecordBatch, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each row's group by ``keys``, and a row of each group; nulls are equal."""
    group = np.zeros(batch.num_rows, np.int64)
    for c in keys:
        column = batch[c]
        if pa.types.is_integer(column.type):
            code = np.unique(np.where(column.is_null().to_numpy(zero_copy_only=False), -1 << 62, arrays.numbers(column)), return_inverse=True)[1]
        else:
            code = arrays.numbers(column.dictionary_encode().indices, -1) + 1
        group = np.unique(group * (code.max(initial=0) + 1) + code, return_inverse=True)[1]
    return group, np.unique(group, return_index=True)[1]


def numbered(group: np.ndarray, pos: np.ndarray, ref: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the loci of bases: for each base its locus; for each locus one base, -1 if it has none."""
    if not len(pos):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    groups = group.max() + 1
    low, high = np.full(groups, 1 << 62), np.full(groups, -1 << 62)
    turn = np.flatnonzero(np.diff(group, prepend=-1))  # rows of a group stand together, or nearly so
    np.minimum.at(low, group[turn], np.minimum.reduceat(pos, turn))
    np.maximum.at(high, group[turn], np.maximum.reduceat(pos, turn))
    size = np.maximum(high - low + 1, 0) * (high >= low)
    first = np.cumsum(size) - size
    places = int(size.sum())
    if places <= SPARSE * len(pos) + AT_ONCE:
        locus = (first - low)[group] + pos
        of = np.full(places, -1)
        of[locus] = np.arange(len(pos))
        if ref is None or (ref[of[locus]] == ref).all():
            return locus, of, np.flatnonzero(of >= 0)
    key = (group * (1 << 32) + pos) * 256 + (0 if ref is None else ref)
    of, locus = np.unique(key, return_index=True, return_inverse=True)[1:]
    return locus, of, np.arange(len(of))


def _out(batch: pa.RecordBatch, keys: list[str], rows: np.ndarray, more: dict) -> pa.RecordBatch:
    taken = pa.array(rows)
    columns = {c: batch[c].take(taken) for c in keys} | more
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _text(letters: np.ndarray) -> pa.Array:
    """One text of one letter a byte; 0 is the empty text."""
    held = letters > 0
    return arrays.texts(letters[held], np.concatenate([[0], np.cumsum(held)]))


def letter_sums(keys: list[str], terms: list[list[int]], pile_quality: int, min_quality: int, every_locus: bool):
    """Per locus: counts of each letter of sufficient quality, and sums of ``terms`` by quality."""
    table = np.array(terms, np.float64)
    code = np.full(256, 4, np.int64)
    code[list(b"ACGT")] = range(4)

    def sums(batches):
        for batch in batches:
            group, _ = grouped(batch, keys)
            for b in laid_out(batch):
                good = ~b.unknown & (b.q >= min_quality)
                b.keep((b.unknown | (b.q >= pile_quality)) if every_locus else good & (b.q >= pile_quality))
                good = ~b.unknown & (b.q >= min_quality)
                locus, of, there = numbered(group[b.row], b.pos, b.ref)
                if not len(there):
                    continue
                shown = good & (code[b.base] < 4)
                cell, q = locus[shown] * 4 + code[b.base[shown]], b.q[shown]
                listed = (q >= 0) & (q < table.shape[1])
                cell_of, q_of = (cell, q) if listed.all() else (cell[listed], q[listed])
                width = len(of) * 4
                counts = np.bincount(cell, minlength=width).reshape(-1, 4)[there]
                # whole numbers far below 2^53, so sums of doubles are exact
                parts = [np.bincount(cell_of, t[q_of], width).reshape(-1, 4)[there].astype(np.int64) for t in table]
                one = of[there]
                more = {"pos": pa.array(b.pos[one].astype(np.int32)), "ref_base": _text(b.ref[one])}
                for i, letter in enumerate("ACGT"):
                    more |= {f"n_{letter}": pa.array(counts[:, i])} | {f"s{k}_{letter}": pa.array(s[:, i]) for k, s in enumerate(parts)}
                yield _out(batch, keys, b.row[one], more)
    return sums


def site_counts(keys: list[str], pile_quality: int):
    """Per locus: rows of the pileup, and those that delete it."""
    def counts(batches):
        for batch in batches:
            group, _ = grouped(batch, keys)
            for b in laid_out(batch):
                b.keep(b.unknown | (b.q >= pile_quality))
                locus, of, there = numbered(group[b.row], b.pos)
                if len(there):
                    one = of[there]
                    yield _out(batch, keys, b.row[one], {
                        "pos": pa.array(b.pos[one].astype(np.int32)), "depth": pa.array(np.bincount(locus, minlength=len(of))[there]),
                        "gone": pa.array(np.bincount(locus[b.base == ord("*")], minlength=len(of))[there])})
    return counts


def mismatch_sums(keys: list[str], pile_quality: int):
    """Per locus with a mismatch: the sum of the qualities of mismatching letters."""
    letter = np.zeros(256, bool)
    letter[list(b"ACGT")] = True

    def sums(batches):
        for batch in batches:
            group, _ = grouped(batch, keys)
            for b in laid_out(batch):
                b.keep((b.unknown | (b.q >= pile_quality)) & letter[b.base] & letter[b.ref] & (b.base != b.ref))
                locus, of, there = numbered(group[b.row], b.pos)
                if len(there):
                    one = of[there]
                    known = ~b.unknown
                    has = np.bincount(locus[known], minlength=len(of))[there]
                    total = np.bincount(locus[known], b.q[known], len(of))[there].astype(np.int64)
                    yield _out(batch, keys, b.row[one], {"pos": pa.array(b.pos[one].astype(np.int32)), "m": pa.array(total, mask=has == 0)})
    return sums


def error_cells(min_quality: int):
    """Per read group, quality, cycle and context: bases that have a reference letter other than N, and mismatches.

    A task has as many rows as cells, which its batches add up to.
    """
    code = np.full(256, -1, np.int64)
    code[list(b"ACGT")] = range(4)
    names = pa.array([x + y for x in "ACGT" for y in "ACGT"])
    middle = 1 << 23

    def added(keys, values):
        keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        return [keys], [np.stack([np.bincount(inverse, v, len(keys)) for v in np.concatenate(values, 1)]).astype(np.int64)]

    def cells(batches):
        numbers, keys, values, held = {}, [], [], 0
        for batch in batches:
            group, row_of = grouped(batch, ["read_group"])
            group = np.array([numbers.setdefault(batch["read_group"][int(r)].as_py(), len(numbers)) for r in row_of])[group]
            reverse, sign, c0, c1 = (arrays.numbers(batch[c]) for c in ("reverse", "sign", "c0", "c1"))
            seq = arrays.ascii_letters(batch["seq"])
            for b in laid_out(batch):
                b.keep((b.ref != ord("N")) & ~b.unknown & (b.q >= min_quality) & (code[b.base] >= 0))
                if not len(b.row):
                    continue
                at = c0[b.row] + c1[b.row] * b.i
                back = reverse[b.row] == 1
                here, other = code[b.base], code[_letter(seq, b.row, np.where(back, b.i + 1, b.i - 1))]
                context = np.where((at > 1) & (other >= 0), np.where(back, (3 - other) * 4 + 3 - here, other * 4 + here), 16)
                if b.q.max() >= 1 << 16 or b.q.min() < 0 or at.max() >= middle or len(numbers) > 1 << 18:
                    raise ValueError("qualities of 0 to 65535, reads under 8388608 bases and 262144 read groups at most")
                key = ((group[b.row] << 16 | b.q) << 24 | (at * sign[b.row] + middle)) << 5 | context
                low, wrong = key.min(), b.base != b.ref
                if key.max() - low < SPARSE * AT_ONCE:
                    n, e = (np.bincount(k - low, minlength=1) for k in (key, key[wrong]))
                    cell = np.flatnonzero(n)
                    n, e, cell = n[cell], np.pad(e, (0, max(len(n) - len(e), 0)))[cell], cell + low
                else:
                    cell, inverse = np.unique(key, return_inverse=True)
                    n, e = np.bincount(inverse), np.bincount(inverse[wrong], minlength=len(cell))
                keys.append(cell)
                values.append(np.stack([n, e]))
                held += len(cell)
                if held > 4 * AT_ONCE:
                    keys, values = added(keys, values)
                    held = len(keys[0])
        if not keys:
            return
        (key,), ((n, e),) = added(keys, values)
        groups = pa.array(list(numbers), pa.string())
        context = key & 31
        yield pa.RecordBatch.from_arrays(
            [groups.take(pa.array(key >> 45)), pa.array((key >> 29 & 65535).astype(np.int32)), pa.array(((key >> 5 & (1 << 24) - 1) - middle).astype(np.int32)),
             names.take(pa.array(context, mask=context == 16)), pa.array(n), pa.array(e)],
            ["read_group", "reported_q", "cycle", "context", "n", "e"])
    return cells


def renewed_qualities(steps: list, reach: int, lowest: int, highest: int):
    """Qualities of reads by the steps (base, by cycle, by context) of each read group and quality; -1 names no group."""
    code = np.full(256, -1, np.int64)
    code[list(b"ACGT")] = range(4)
    groups, width = len(steps), 2 * reach + 1
    base, by_cycle, by_context = np.full((groups, 94), -1 << 31), np.zeros((groups, 94, width), np.int64), np.zeros((groups, 94, 16), np.int64)
    for g, of in enumerate(steps):
        for q, step in enumerate(of):
            if step is not None:
                base[g, q], by_cycle[g, q], by_context[g, q] = step

    def renewed(group: pa.Array, seq: pa.Array, quals: pa.Array, reverse: pa.Array, sign: pa.Array) -> pa.Array:
        data, starts = arrays.lists(quals, -1 << 31)
        group, reverse, sign, text = arrays.numbers(group), arrays.numbers(reverse) == 1, arrays.numbers(sign), arrays.ascii_letters(seq)
        size, out = np.diff(starts), data.copy()
        part = np.cumsum(size) // AT_ONCE
        for rows in np.split(np.arange(len(part)), np.flatnonzero(np.diff(part)) + 1) if groups else []:
            if not len(rows) or not size[rows].any():
                continue
            row = np.repeat(rows, size[rows])
            at = np.arange(starts[rows[0]], starts[rows[-1] + 1])
            q, g = data[at], group[row]
            some = (q >= lowest) & (q < 94) & (g >= 0)
            row, at, q, g = row[some], at[some], q[some], g[some]
            some = base[g, q] > -1 << 31
            row, at, q, g = row[some], at[some], q[some], g[some]
            back, i = reverse[row], at - starts[row]
            i = np.where(back, size[row] - 1 - i, i)
            letters = np.diff(text[1])[row]
            place = np.where(back, letters - 1 - i, i)
            here, before = code[_letter(text, row, place)], code[_letter(text, row, np.where(back, place + 1, place - 1))]
            known = (i > 0) & (here >= 0) & (before >= 0)
            context = np.where(back, (3 - before) * 4 + 3 - here, before * 4 + here)
            cycle = sign[row] * (i + 1) + reach
            listed = (cycle >= 0) & (cycle < width)
            total = base[g, q] + np.where(listed, by_cycle[g, q, np.where(listed, cycle, 0)], 0) + np.where(known, by_context[g, q, np.where(known, context, 0)], 0)
            out[at] = np.clip(total, 1, highest)
        return pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(out.astype(np.int32), mask=data == -1 << 31))
    return renewed


def _ranked(batch: pa.RecordBatch, b: Bases, n: int) -> np.ndarray:
    """The bases among the first ``n`` of their locus, in the order of digest, name and mate of the read."""
    group, _ = grouped(batch, ["contig_idx"])
    locus = numbered(group[b.row], b.pos)[0]
    order = pc.sort_indices(pa.table({c: batch[c] for c in ("_d", "read_name", "mate")}), null_placement="at_start",
                            sort_keys=[(c, "ascending") for c in ("_d", "read_name", "mate")]).to_numpy()
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    turn = np.argsort(locus * len(order) + place[b.row], kind="stable")
    locus = locus[turn]
    begins = np.flatnonzero(np.diff(locus, prepend=-1))
    rank = np.arange(len(locus)) - np.repeat(begins, np.diff(begins, append=len(locus)))
    return np.sort(turn[rank < n])


def _thinned(batch: pa.RecordBatch, n: int, pile_quality: int) -> pa.RecordBatch:
    """The rows that are among the first ``n`` at a locus of theirs, compared with rows that stand near them."""
    held = [np.zeros(0, np.int64)]
    for b in laid_out(batch):
        b.keep(b.unknown | (b.q >= pile_quality))
        if len(b.row):
            held.append(np.unique(b.row[_ranked(batch, b, n)]))
    rows = np.concatenate(held)
    return batch if len(rows) == batch.num_rows else batch.take(pa.array(rows))


def thinned_pieces(n: int, pile_quality: int):
    """Pieces of reads without those of which no base can be among the first ``n`` of a locus."""
    def thinned(batches):
        for batch in batches:
            yield _thinned(batch, n, pile_quality)
    return thinned


def first_bases(n: int, pile_quality: int, columns: list[str]):
    """The first ``n`` bases of every locus as rows; a task gets the pieces of a bin (``contig_idx, _bin``) one after another.

    Of the bin that is being gathered, rows without a base among the first ``n`` so far are dropped again and again.
    """
    def rows_of(batch):
        for b in laid_out(batch, 1 << 62):
            b.keep(b.unknown | (b.q >= pile_quality))
            if not len(b.row):
                continue
            b.keep(_ranked(batch, b, n))
            taken = pa.array(b.row)
            lost = batch["seq"].is_null().to_numpy(zero_copy_only=False)[b.row] & ~b.gone
            base = _text(b.base)
            made = {"pos": pa.array(b.pos.astype(np.int32)), "ref_base": _text(b.ref), "base": pc.if_else(pa.array(lost), pa.scalar(None, pa.string()), base),
                    "q": pa.array(np.where(b.unknown, 0, b.q).astype(np.int32), mask=b.unknown)}
            out = pa.RecordBatch.from_arrays([made[c] if c in made else batch[c].take(taken) for c in columns], columns)
            for at in range(0, out.num_rows, 1 << 16):
                yield out.slice(at, 1 << 16)

    def bases(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            key = (arrays.numbers(batch["contig_idx"]) << 32) + arrays.numbers(batch["_bin"])
            last = int(np.flatnonzero(key == key[-1])[0])  # where the last bin begins
            if held and key[0] != held[0]:
                yield from rows_of(_joined(held[1]))
                held, size = [], 0
            if last or not held:
                if last:
                    yield from rows_of(_joined([*(held[1] if held else []), batch.slice(0, last)]))
                held, size = [key[-1], []], 0
            held[1].append(batch.slice(last))
            size += int((arrays.numbers(batch["_hi"]) - arrays.numbers(batch["_lo"]) + 1)[last:].sum())
            if size > 4 * AT_ONCE and len(held[1]) > 1:
                held[1] = [_thinned(_joined(held[1]), n, pile_quality)]
                size = int((arrays.numbers(held[1][0]["_hi"]) - arrays.numbers(held[1][0]["_lo"]) + 1).sum()) // 2
        if held:
            yield from rows_of(_joined(held[1]))
    return bases


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)
