"""Rows, ranks, breakpoints and summaries after sequence calls, against a plain version of one locus at a time."""

import collections
import random

from genespark.operators import loci as L

IN = {L.IN_PLACE, L.RESCUE_IN}


def row_class(block, common):
    if sum(c == L.DNA_ABSENT for c in block) / len(block) >= 0.8:
        return "empty"
    if all(c in IN for c in block):
        return "full"
    if all(c in IN or c == L.DNA_PRESENT for c in block):
        return "model_difference" if any(c == L.DNA_PRESENT and ok for c, ok in zip(block, common)) else "variable_gap"
    return "partial"


def test_recount_equals_one_locus_at_a_time(spark):
    r = random.Random(21)
    n_left, n_locus, n_right = 2, 4, 2
    width = n_left + n_locus + n_right
    part = ["left"] * n_left + ["locus"] * n_locus + ["right"] * n_right
    strains = [(f"S{i}", f"sp{i % 3}") for i in range(120)]
    cells, rows, mask, calls, cols = [], [], [], [], []
    codes, classes, used, support, called = {}, {}, {}, {}, {}
    for locus in ("L1", "L2", "L3"):
        cols += [(locus, c, f"{locus}f{c}", part[c]) for c in range(width)]
        weights = {"L1": (1, 6, 1), "L2": (5, 3, 1), "L3": (3, 3, 3)}[locus]
        for s, _ in strains[:100 if locus == "L2" else 120]:
            kind = r.choices([L.ABSENT, L.IN_PLACE, L.ELSEWHERE], weights)[0]
            codes[locus, s] = [L.IN_PLACE if part[c] != "locus" and r.random() < 0.8 else kind if r.random() < 0.8 else r.choice([L.ABSENT, L.IN_PLACE, L.ELSEWHERE, L.RESCUE_IN, L.RESCUE_OUT, L.BREAK])
                               for c in range(width)]
        for c in range(n_left, n_left + n_locus):
            support[locus, c] = sum(v[c] == L.IN_PLACE for (k, _), v in codes.items() if k == locus)
            used[locus, c] = int(c != n_left or locus != "L3")
            mask.append((locus, c, support[locus, c], used[locus, c]))
    for (locus, s), v in codes.items():
        block = [x for c, x in enumerate(v) if used.get((locus, c))]
        a = sum(x == L.ABSENT for x in block) / len(block)
        classes[locus, s] = "uninformative" if r.random() < 0.1 else "empty" if a >= 0.8 else "full" if all(x in IN for x in block) else "partial"
        rows.append((locus, s, classes[locus, s], "".join(v)))
        cells += [(locus, s, c, f"{locus}f{c}", part[c], x, x) for c, x in enumerate(v)]
        for c in range(width):
            if r.random() < 0.6:
                called[locus, s, c] = r.choices(["present", "absent", "unchecked"], (2, 4, 1))[0]
                calls.append((locus, s, c, called[locus, s, c]))
    frame = lambda data, schema: spark.createDataFrame(data, schema)
    got_rows, got_ranks, got_tracks, got_summary = L.dna_recount(
        frame(cells, "locus_id string, short string, col int, family string, part string, base string, code string"),
        frame(rows, "locus_id string, short string, row_class string, codes string"), frame(mask, "locus_id string, col int, support bigint, used int"),
        frame(calls, "locus_id string, short string, col int, call string"), frame(cols, "locus_id string, col int, family string, part string"),
        frame(strains, "short string, species string"))

    species, want_rows, touched = dict(strains), {}, set()
    summary = collections.defaultdict(collections.Counter)
    for (locus, s), v in codes.items():
        cls, v = classes[locus, s], list(v)
        mine = {c: called.get((locus, s, c)) for c in range(width)}
        if cls in ("partial", "empty"):
            if any(x in ("present", "absent") for x in mine.values()):
                touched.add((locus, s))
                for c, x in mine.items():
                    if part[c] == "locus" and v[c] in (L.ABSENT, L.ELSEWHERE, L.RESCUE_OUT) and x in ("present", "absent"):
                        v[c] = L.DNA_PRESENT if x == "present" else L.DNA_ABSENT
                n = sum(k == locus for k, _ in codes)
                at = [c for c in range(n_left, n_left + n_locus) if used[locus, c]]
                new = row_class([v[c] for c in at], [support[locus, c] >= 0.5 * n for c in at])
                summary[locus]["checked"] += 1
                summary[locus]["empty_confirmed"] += new == "empty"
                summary[locus]["empty_to_model_difference"] += cls == "empty" and new == "model_difference"
                cls = new
            else:
                summary[locus]["unchecked"] += 1
        want_rows[locus, s] = (cls, "".join(v))
    assert {(x.locus_id, x.short): (x.row_class, x.codes) for x in got_rows.collect()} == want_rows
    assert {x.locus_id: (x.checked, x.unchecked, x.empty_confirmed, x.empty_to_model_difference) for x in got_summary.collect()} == {
        k: (c["checked"], c["unchecked"], c["empty_confirmed"], c["empty_to_model_difference"]) for k, c in summary.items()}

    ranks = {x.locus_id: x for x in got_ranks.collect()}
    for locus in ("L1", "L2", "L3"):
        count, by = collections.Counter(), collections.defaultdict(collections.Counter)
        for (k, s), (cls, v) in want_rows.items():
            if k == locus:
                count[cls] += cls != "empty" or (k, s) in touched
                if cls != "uninformative":
                    loss = cls == "empty" or cls == "partial" and L.DNA_ABSENT in v[n_left:n_left + n_locus]
                    by[species[s]]["loss" if loss else "car"] += 1
        whole = lambda full: min(count["empty"], full) if count["empty"] >= 10 and full >= 2 else -1
        got = ranks[locus]
        assert got.whole_annot == whole(count["full"])
        assert got.whole_dna == whole(count["full"] + count["model_difference"] + count["variable_gap"])
        car, loss = (sum(d[x] for d in by.values()) for x in ("car", "loss"))
        assert (got.carriers, got.losses, got.presence) == (car, loss, min(car, loss) if loss >= 10 and car >= 2 else -1)
        poly = [(-min(d["car"], d["loss"]), sp) for sp, d in by.items() if sum(d.values()) >= 20 and 0.05 <= d["loss"] / sum(d.values()) <= 0.95]
        assert (got.within, got.within_species) == ((-min(poly)[0], min(poly)[1]) if poly else (-1, None))

    tracks = collections.Counter()
    for (locus, s), (cls, v) in want_rows.items():
        seen = [L.ELSEWHERE if x in (L.ABSENT, L.DNA_PRESENT) else L.ABSENT if x == L.DNA_ABSENT else x for x in v]
        for c in range(1, width):
            pair = {seen[c - 1] in IN, seen[c] in IN}
            other = seen[c] if seen[c - 1] in IN else seen[c - 1]
            if pair == {True, False}:
                tracks[locus, c, species[s], "indel"] += other == L.ABSENT and cls != "uninformative"
                tracks[locus, c, species[s], "break"] += other == L.BREAK
    got = collections.Counter()
    for x in got_tracks.collect():
        got[x.locus_id, x.boundary, x.species, "indel"] += x.indel
        got[x.locus_id, x.boundary, x.species, "break"] += x.contig_break
    assert +got == +tracks and +got
