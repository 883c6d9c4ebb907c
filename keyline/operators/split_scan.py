"""Per-split audit summaries without a shuffle (``mapInArrow``).

Each task of a file scan reads whole input splits, in file order. The previous
non-blank record of a line is therefore in the same task, usually in the same
Arrow batch; the only state carried across batches is the last non-blank record
of the current split. Adjacent-pair tests (order break, equal text) run as
vectorised Arrow compute kernels over whole batches; Python touches only the
few summary values per split (first/last record, first violation, first
duplicate). Output: one row per split, the same facts as the window form in
``keyline.operators.audit``, so the same stitch applies.

Why not the window form: ``Window.partitionBy(split)`` is correct and bounded
(one group per split) but hash-shuffles the whole sorted file once. This pass
reads it once and shuffles nothing but the per-split rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SUMMARY_SCHEMA = (
    "_f string, _b bigint, n_lines bigint, m0 bigint, "
    "first_m bigint, first_ok boolean, first_k binary, first_n bigint, first_t string, "
    "last_m bigint, last_ok boolean, last_k binary, last_n bigint, last_t string, "
    "viol_m bigint, viol_has_prev boolean, viol_prev_line string, viol_cur_line string, "
    "dup_m bigint, n_blank bigint, viol_blank bigint"
)
_FIELDS = [f.strip().split(" ")[0] for f in SUMMARY_SCHEMA.split(",")]


def _fmt(n, k, t, joiner):
    text = t if t is not None else k.decode("utf-8", "surrogateescape")
    return text if joiner is None else f"{n}{joiner}{text}"


class _Split:
    __slots__ = _FIELDS

    def __init__(self, f, b):
        for name in _FIELDS:
            setattr(self, name, None)
        self._f, self._b, self.n_lines, self.n_blank = f, b, 0, 0


def _summaries(batches, joiner, number_first):
    """``mapInArrow`` body: input columns ``_f, _fh, _b, _m, _blank, _ok, _k, _n, _t, _bad``."""
    splits: dict[tuple[int, int], _Split] = {}
    carry = None  # (split key, m, ok, k, n, t) of the last non-blank line seen
    for rb in batches:
        rows = rb.num_rows
        if rows == 0:
            continue
        fh = rb.column("_fh").to_numpy(zero_copy_only=False)
        bb = rb.column("_b").to_numpy(zero_copy_only=False)
        mm = rb.column("_m").to_numpy(zero_copy_only=False)
        blank = rb.column("_blank").to_numpy(zero_copy_only=False).astype(bool)
        # Split runs: rows of a split are contiguous within a task.
        change = np.ones(rows, dtype=bool)
        change[1:] = (fh[1:] != fh[:-1]) | (bb[1:] != bb[:-1])
        starts = np.flatnonzero(change)
        ends = np.append(starts[1:], rows)
        run_of = np.repeat(np.arange(len(starts)), ends - starts)
        run_keys, blank_before = [], []
        for s, e in zip(starts, ends):
            key = (int(fh[s]), int(bb[s]))
            sp = splits.get(key)
            if sp is None:
                sp = splits[key] = _Split(rb.column("_f")[int(s)].as_py(), int(bb[s]))
                sp.m0 = int(mm[s])
            sp.n_lines += int(e - s)
            blank_before.append(sp.n_blank)
            sp.n_blank += int(blank[s:e].sum())
            run_keys.append(key)

        nb = np.flatnonzero(~blank)
        if len(nb) == 0:
            continue
        ok = rb.column("_ok").take(pa.array(nb)).fill_null(False).to_numpy(zero_copy_only=False).astype(bool)
        k = rb.column("_k").take(pa.array(nb))
        n = rb.column("_n").take(pa.array(nb)).fill_null(0).to_numpy(zero_copy_only=False)
        t = rb.column("_t").take(pa.array(nb))
        bad = rb.column("_bad").take(pa.array(nb))
        runs = run_of[nb]

        # Previous non-blank line: the one before in this batch, or the carry.
        first_key = run_keys[runs[0]]
        has_carry = carry is not None and carry[0] == first_key
        prev_same = np.zeros(len(nb), dtype=bool)
        prev_same[1:] = runs[1:] == runs[:-1]
        prev_same[0] = has_carry
        if has_carry:
            pk = pa.concat_arrays([pa.array([carry[3]], type=pa.binary()), k.slice(0, len(nb) - 1)])
            pn = np.concatenate([[carry[4] if carry[4] is not None else 0], n[:-1]])
            pok = np.concatenate([[carry[2]], ok[:-1]])
        else:
            pk = pa.concat_arrays([pa.array([b""], type=pa.binary()), k.slice(0, len(nb) - 1)])
            pn = np.concatenate([[0], n[:-1]])
            pok = np.concatenate([[False], ok[:-1]])
        both = prev_same & ok & pok
        lt = pc.fill_null(pc.less(k, pk), False).to_numpy(zero_copy_only=False)
        eq = pc.fill_null(pc.equal(k, pk), False).to_numpy(zero_copy_only=False)
        brk = both & ((n < pn) | ((n == pn) & lt) if number_first else lt | (eq & (n < pn)))
        violation = ~ok | brk
        dup = both & eq

        # Per split in this batch: first/last non-blank, first violation, first duplicate.
        run_change = np.ones(len(nb), dtype=bool)
        run_change[1:] = runs[1:] != runs[:-1]
        seg_starts = np.flatnonzero(run_change)
        seg_ends = np.append(seg_starts[1:], len(nb))
        for s, e in zip(seg_starts, seg_ends):
            sp = splits[run_keys[runs[s]]]
            if sp.first_m is None:
                sp.first_m, sp.first_ok = int(mm[nb[s]]), bool(ok[s])
                if ok[s]:
                    sp.first_k, sp.first_n, sp.first_t = k[int(s)].as_py(), int(n[s]), t[int(s)].as_py()
            last = e - 1
            sp.last_m, sp.last_ok = int(mm[nb[last]]), bool(ok[last])
            if ok[last]:
                sp.last_k, sp.last_n, sp.last_t = k[int(last)].as_py(), int(n[last]), t[int(last)].as_py()
            else:
                sp.last_k = sp.last_n = sp.last_t = None
            if sp.viol_m is None:
                hits = np.flatnonzero(violation[s:e])
                if len(hits):
                    i = int(s + hits[0])
                    has_prev = bool(prev_same[i])
                    sp.viol_m, sp.viol_has_prev = int(mm[nb[i]]), has_prev
                    sp.viol_blank = blank_before[runs[i]] + int(blank[starts[runs[i]] : nb[i]].sum())
                    if has_prev and pok[i]:
                        if i > 0:
                            sp.viol_prev_line = _fmt(int(n[i - 1]), k[i - 1].as_py(), t[i - 1].as_py(), joiner)
                        else:
                            sp.viol_prev_line = _fmt(carry[4], carry[3], carry[5], joiner)
                    sp.viol_cur_line = _fmt(int(n[i]), k[i].as_py(), t[i].as_py(), joiner) if ok[i] else bad[i].as_py()
            if sp.dup_m is None:
                hits = np.flatnonzero(dup[s:e])
                if len(hits):
                    sp.dup_m = int(mm[nb[int(s + hits[0])]])
        j = len(nb) - 1
        carry = (
            run_keys[runs[j]],
            int(mm[nb[j]]),
            bool(ok[j]),
            k[j].as_py() if ok[j] else b"",
            int(n[j]) if ok[j] else None,
            t[j].as_py() if ok[j] else None,
        )
    if splits:
        cols = {name: [getattr(sp, name) for sp in splits.values()] for name in _FIELDS}
        yield pa.RecordBatch.from_pydict(cols, schema=_arrow_schema())


def summarize_partition(joiner: str | None = ". ", number_first: bool = False):
    """The ``mapInArrow`` function for records written with ``joiner`` between number and
    text (None: as the text alone), ordered by text then number (or number then text)."""
    return lambda batches: _summaries(batches, joiner, number_first)


def _arrow_schema():
    types = {
        "string": pa.string(),
        "bigint": pa.int64(),
        "boolean": pa.bool_(),
        "binary": pa.binary(),
    }
    fields = []
    for part in SUMMARY_SCHEMA.split(","):
        name, typ = part.strip().split(" ")
        fields.append(pa.field(name, types[typ]))
    return pa.schema(fields)
