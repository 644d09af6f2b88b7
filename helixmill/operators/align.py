"""Local alignment of probes and primers to amplicons, in Arrow batches.

Scores are 4 for a match, 0 for a mismatch and -12 for each gap letter. As costs: a letter of
the probe that doesn't match or isn't aligned costs 1, a target letter skipped between two of
the probe's 3, a skipped probe letter 4; the score is 4 times the letters less the cost. The
probe may overhang the target's ends. A cost below 3 has no gap, so all places are compared
without gaps first, many pairs at once; the rest go through a recurrence over cells that hold
cost, start and unmatched last letters as one number. Rows are independent: the work is spread
as the rows are.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from helixmill.functions.sequence import COMPLEMENT, IUPAC
from helixmill.operators.mapping import Seeds

MATCH, GAP = 4, -12


def codes(seq: str) -> np.ndarray:
    return np.frombuffer(seq.upper().encode("ascii", "replace"), dtype=np.uint8)


_PARTNERS = str.maketrans(COMPLEMENT)


def complemented(seq: str) -> str:
    return seq.upper().translate(_PARTNERS)[::-1]


#: Concrete sequences that one degenerate oligo may stand for; more raise an error.
MOST_VARIANTS = 65_536
#: Probes of a panel, which every task holds; more raise an error.
MOST_PROBES = 100_000


@lru_cache(4096)
def expanded(seq: str) -> tuple[str, ...]:
    """All concrete sequences of a degenerate one, in order."""
    n = math.prod(len(IUPAC.get(c, c)) for c in seq.upper())
    if n > MOST_VARIANTS:
        raise ValueError(f"{seq} stands for {n} sequences, more than {MOST_VARIANTS}")
    return tuple("".join(x) for x in product(*[IUPAC.get(c, c) for c in seq.upper()]))


#: Cells of one lot of pairs.
LOT = 1 << 18
#: A cell of the recurrence: cost, then start (from the first place that a probe can have), then
#: unmatched letters at the probe's end.
_COST, _START = 1 << 44, 1 << 8


def _ungapped(probes: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(cost, place) of each row's first best placement without gaps."""
    n = probes.shape[1]
    places = targets.shape[1] - n + 1
    cost = np.zeros((len(targets), places), np.uint8 if n < 256 else np.uint16)
    for i in range(n):
        cost += targets[:, i : i + places] != probes[:, i : i + 1]
    at = cost.argmin(axis=1)
    return cost[np.arange(len(targets)), at].astype(np.int64), at


def _gapped(probes: np.ndarray, targets: np.ndarray, end: int) -> np.ndarray:
    """The least cell of each column's alignments."""
    n = len(probes)
    ramp = np.arange(len(targets) + 1, dtype=np.int64)[:, None]
    now = np.repeat(ramp * _START, targets.shape[1], axis=1)
    ramp = ramp * (-GAP // MATCH * _COST)
    for i, letter in enumerate(probes):
        last = int(i >= n - end)
        skipped = now + ((1 - GAP // MATCH) * _COST + last)
        now[1:] = now[:-1] + (targets != letter) * np.int64(_COST + last)
        now[0] = skipped[0]
        np.minimum(now, skipped, out=now)
        if i < n - 1:  # target letters are skipped
            now = np.minimum.accumulate(now - ramp, axis=0) + ramp
    return now.min(axis=0)


def best_sites(pairs: list[tuple[np.ndarray, np.ndarray]], end: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(cost, start, unmatched) for each pair of a probe and a target: of the alignments of the
    least cost those of the least start, and of these the fewest unmatched letters among the
    probe's last `end`.

    A start is where the probe's first letter lies in the target, from 0, and negative if it
    overhangs. An empty probe costs nothing and starts at 0; a probe that the target holds as it
    is starts at its first place. The others are laid out as rows of one matrix, many at once.
    """
    cost, start, unmatched = (np.zeros(len(pairs), np.int64) for _ in range(3))
    start[:] = [t.tobytes().find(p.tobytes()) for p, t in pairs]
    order = sorted(np.flatnonzero(start < 0).tolist(), key=lambda i: (len(pairs[i][0]), len(pairs[i][1])))
    at = 0
    while at < len(order):
        n = len(pairs[order[at]][0])
        lot = [order[at]]
        at += 1
        while at < len(order) and len(pairs[order[at]][0]) == n and (len(lot) + 1) * (len(pairs[order[at]][1]) + 2 * n) <= LOT:
            lot.append(order[at])
            at += 1
        targets = np.zeros((len(lot), len(pairs[lot[-1]][1]) + 2 * n), np.uint8)
        for row, i in enumerate(lot):
            targets[row, n : n + len(pairs[i][1])] = pairs[i][1]
        probes = np.stack([pairs[i][0] for i in lot])
        c, s = _ungapped(probes, targets)
        tail = np.arange(max(0, n - end), n)
        u = (targets[np.arange(len(lot))[:, None], s[:, None] + tail] != probes[:, tail]).sum(axis=1)
        far = np.flatnonzero(c >= -GAP // MATCH)
        if len(far):
            cell = _gapped(np.ascontiguousarray(probes[far].T), np.ascontiguousarray(targets[far].T), end)
            c[far], s[far], u[far] = cell // _COST, cell % _COST // _START, cell % _START
        cost[lot], start[lot], unmatched[lot] = c, s - n, u
    return cost, start, unmatched


def probe_entries(probe: str) -> list[tuple[np.ndarray, str]]:
    """A probe's variants on both strands, in the order in which equally good ones are taken:
    earlier variants first, the minus strand first."""
    return [(codes(s), strand) for v in expanded(probe) for s, strand in ((complemented(v), "Minus"), (v, "Plus"))]


def best_score(probe: np.ndarray, target: np.ndarray) -> tuple[int, int]:
    """(score, start) of one probe on one target."""
    cost, start, _ = best_sites([(probe, target)])
    return MATCH * (len(probe) - int(cost[0])), int(start[0])


def probe_site(probe: str, amplicon: str, limit: int) -> tuple[int, int, str] | None:
    """(mismatches, 0-based start, strand) of the best accepted variant of one probe."""
    entries = probe_entries(probe)
    cost, start, _ = best_sites([(letters, codes(amplicon)) for letters, _ in entries])
    at = int(cost.argmin())
    return (int(cost[at]), max(0, int(start[at])), entries[at][1]) if cost[at] <= limit else None


class Panel:
    """All probes of a panel against many amplicons at once.

    Costs count mismatches: a letter that doesn't match or isn't aligned costs 1, a skipped
    target letter 3 and a skipped probe letter 4, as the scores do. Amplicons lie in one buffer
    with more blanks between them than an alignment may cost; for every variant and strand,
    in probe_entries' order, numpy adds up the costs of all places. A gap costs 3, so amplicons
    that have a place of less without gaps are settled, and one gap letter is the most below 6;
    only from there on the recurrence runs everywhere.

    A place of cost 3 at most has a half of the probe that differs in one letter at most, and so
    have the halves that an alignment with a gap and a cost of 4 at most leaves without one. All
    such halves are looked up at once; only amplicons without a place of cost 3 are swept.
    """

    BUFFER = 1 << 16
    #: Halves with their variants that are looked up at most, and a half's least letters; panels
    #: beyond that are swept.
    HALVES, SHORTEST = 1 << 18, 7
    #: The cost up to which looking up finds every place without gaps, and that of gaps.
    NEAR = 3

    def __init__(self, probes: list[tuple[str, str]], limit: int):
        self.probes, self.limit = probes, limit
        self.entries = []
        for at, (_, seq) in enumerate(probes):
            for variant in expanded(seq):
                self.entries += [(at, complemented(variant).encode("ascii", "replace"), "Minus"), (at, variant.encode("ascii", "replace"), "Plus")]
        self.longest = max((len(e[1]) for e in self.entries), default=0)
        self.kind = np.uint8 if self.longest < 250 else np.uint16
        self.letters = sorted({c for e in self.entries for c in e[1]})
        self.indexes: dict[bytes, list[tuple[Seeds, np.ndarray, np.ndarray, np.ndarray]] | None] = {}
        self.sizes = np.array([len(e[1]) for e in self.entries], np.int64)
        self.padded = np.zeros((len(self.entries), self.longest), np.uint8)
        for number, (_, letters, _) in enumerate(self.entries):
            self.padded[number, : len(letters)] = np.frombuffer(letters, np.uint8)

    def halves(self, alphabet: np.ndarray) -> list[tuple[Seeds, np.ndarray, np.ndarray, np.ndarray]] | None:
        """(index, entry, offset, cost) by length of all halves as they are and with one letter
        replaced by another one of the alphabet; None if those are too many or too short."""
        key = alphabet.tobytes()
        if key not in self.indexes:
            self.indexes[key] = None
            if len(self.entries) and self.sizes.min() // 2 >= self.SHORTEST and len(self.entries) * (self.longest + 2) * len(alphabet) <= self.HALVES:
                parts: dict[int, list[tuple[int, int, bytes]]] = {}
                for number, (_, letters, _) in enumerate(self.entries):
                    middle = len(letters) // 2
                    for at, half in ((0, letters[:middle]), (middle, letters[middle:])):
                        parts.setdefault(len(half), []).append((number, at, half))
                found = []
                for n, rows in parts.items():
                    entry, offset = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
                    exact = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(-1, n).astype(np.uint32)
                    words, own = [exact], [np.arange(len(rows))]
                    for i in range(n):
                        for letter in alphabet.tolist():
                            other = np.flatnonzero(exact[:, i] != letter)
                            words.append(exact[other])
                            words[-1][:, i] = letter
                            own.append(other)
                    row = np.concatenate(own)
                    found.append((Seeds(np.concatenate(words)), entry[row], offset[row], (np.arange(len(row)) >= len(rows)).astype(np.int64)))
                self.indexes[key] = found
        return self.indexes[key]

    def near(self, buffer: np.ndarray, indexes: list) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(entry, start, cost of the half) of the halves in a buffer with one differing letter at most."""
        for index, entry, offset, cost in indexes:
            for places, words in index.find(buffer):
                yield entry[words], places - offset[words], cost[words]

    def looked_up(self, targets: list[np.ndarray], best: list[tuple[int, int]]) -> None:
        """As swept without gaps, for costs up to NEAR; best[i] stays where there is none."""
        buffer, bounds = self.laid_out(targets)
        indexes = self.halves(np.unique(buffer))
        if indexes is None:
            return
        starts, most = np.array([b[0] for b in bounds]), len(self.entries)
        least = np.full(len(targets), (min(self.NEAR, self.limit) + 1) * most)
        for entry, place, _ in self.near(buffer, indexes):
            for n in np.unique(self.sizes[entry]).tolist():
                own = self.sizes[entry] == n
                e, p = entry[own], place[own]
                cost = (buffer[p[:, None] + np.arange(n)] != self.padded[e, :n]).sum(axis=1)
                np.minimum.at(least, np.searchsorted(starts, p, "right") - 1, cost * most + e)
        for i, x in enumerate(least.tolist()):
            if x < (min(self.NEAR, self.limit) + 1) * most:
                best[i] = min(best[i], divmod(x, most))

    def laid_out(self, targets: list[np.ndarray]) -> tuple[np.ndarray, list[tuple[int, int]]]:
        """The buffer, and for each amplicon the bounds of its places: (first start, behind the last end)."""
        blank = 2 * self.longest + self.limit + 4  # bounds don't overlap
        size = blank + sum(len(t) + blank for t in targets)
        buffer, at, bounds = np.zeros(size, np.uint8), blank, []
        for t in targets:
            buffer[at : at + len(t)] = t
            bounds.append((at - self.longest, at + len(t) + self.longest))
            at += len(t) + blank
        return buffer, bounds

    def swept(self, targets: list[np.ndarray], best: list[tuple[int, int]], gaps: bool) -> None:
        """Sets best[i] to (cost, entry) of the first entry with the least cost below best[i]'s."""
        buffer, bounds = self.laid_out(targets)
        cost = {bytes([c]): (buffer != c).astype(self.kind) for c in self.letters}
        ceiling = np.zeros(len(buffer), self.kind)
        for (low, high), b in zip(bounds, best, strict=True):
            ceiling[low:high] = b[0]
        starts = np.array([b[0] for b in bounds])
        total, below, spare = np.empty_like(ceiling), np.empty(len(buffer), bool), np.empty_like(ceiling)
        for number, (_, letters, _) in enumerate(self.entries):
            now = self.gapped(letters, cost, total, spare) if gaps else self.ungapped(letters, cost, total)
            hit = np.less(now, ceiling[: len(now)], out=below[: len(now)])
            if hit.any():
                places = np.flatnonzero(hit)
                for i in np.unique(np.searchsorted(starts, places, "right") - 1).tolist():
                    low, high = bounds[i]
                    best[i] = int(now[low : high if gaps else high - len(letters) + 1].min()), number
                    ceiling[low:high] = best[i][0]

    def ungapped(self, letters: bytes, cost: dict[bytes, np.ndarray], total: np.ndarray) -> np.ndarray:
        """Costs without gaps by start; three letters' costs are summed once for all entries."""
        out = total[: len(total) - max(len(letters), 1) + 1]
        for i in range(0, len(letters), 3):
            piece = letters[i : i + 3]
            if piece not in cost:
                summed = np.zeros_like(total)
                for j in range(len(piece)):
                    summed[: len(total) - j] += cost[piece[j : j + 1]][j:]
                cost[piece] = summed
            if i:
                np.add(out, cost[piece][i : i + len(out)], out=out)
            else:
                out[:] = cost[piece][: len(out)]
        if not letters:
            out[:] = 0
        return out

    def with_one_gap(self, targets: list[np.ndarray], best: list[tuple[int, int]]) -> None:
        """As swept with gaps, for costs that leave room for one gap letter.

        It lies in one half of the probe (or between them). The other half has no gap and at
        most the cost less 3; the recurrence only runs in windows round such halves.
        """
        buffer, bounds = self.laid_out(targets)
        cost = {bytes([c]): (buffer != c).astype(self.kind) for c in self.letters}
        ceiling = np.zeros(len(buffer), self.kind)
        for (low, high), b in zip(bounds, best, strict=True):
            ceiling[low:high] = b[0] + GAP // MATCH + 1
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        starts = np.array([b[0] for b in bounds])
        near = self.halves(np.unique(buffer)) if max(c for c, _ in best) <= self.NEAR + 1 else None
        if near is not None:
            room, number = np.array([c + GAP // MATCH for c, _ in best]), np.array([e for _, e in best])
            for entry, place, cost in self.near(buffer, near):
                owner = np.searchsorted(starts, place, "right") - 1
                fits = cost <= room[owner] - (entry >= number[owner])
                entry, place = entry[fits], place[fits]
                for n in np.unique(self.sizes[entry]).tolist():
                    found.setdefault(n, []).append((entry[self.sizes[entry] == n], place[self.sizes[entry] == n]))
        else:
            for number, place in self.swept_halves(cost, ceiling, bounds, best):
                found.setdefault(int(self.sizes[number]), []).append((np.full(len(place), number), place))
        for n, hits in found.items():
            numbers = np.concatenate([e for e, _ in hits])
            places = np.concatenate([p for _, p in hits])
            for cut in range(0, len(places), 1 << 12):
                entry, place = numbers[cut : cut + (1 << 12)], places[cut : cut + (1 << 12)]
                index = place[:, None] + np.arange(-1, n + 1)
                window = np.where((index >= 0) & (index < len(buffer)), buffer[np.clip(index, 0, len(buffer) - 1)], 0)
                probe = np.frombuffer(b"".join(self.entries[e][1] for e in entry), np.uint8).reshape(-1, n)
                least = self.recurrence(probe.T[:, None, :], window.T).min(axis=0)
                owner = np.searchsorted(starts, place + 1, "right") - 1
                for i, c, e in zip(owner.tolist(), least.tolist(), entry.tolist(), strict=True):
                    best[i] = min(best[i], (c, e))

    def swept_halves(self, cost: dict[bytes, np.ndarray], ceiling: np.ndarray, bounds: list[tuple[int, int]], best: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
        """(entry, starts) of the halves whose cost is below the ceiling."""
        total, below = np.empty_like(ceiling), np.empty(len(ceiling), bool)
        own: dict[int, list[tuple[int, int]]] = {}
        for bound, b in zip(bounds, best, strict=True):
            own.setdefault(b[1], []).append(bound)
        for number, (_, letters, _) in enumerate(self.entries):
            for low, high in own.get(number, []):  # from here on an entry must be better
                ceiling[low:high] -= 1
            middle = len(letters) // 2
            for at, half in ((0, letters[:middle]), (middle, letters[middle:])):
                now = self.ungapped(half, cost, total)
                hit = np.less(now, ceiling[: len(now)], out=below[: len(now)])
                if hit.any():
                    yield number, np.flatnonzero(hit) - at

    def recurrence(self, probe: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Least costs of each column's probe by end in its target."""
        now = np.zeros(target.shape, self.kind)
        for i, letter in enumerate(probe):
            skipped = now + self.kind(1 - GAP // MATCH)
            now[1:] = now[:-1].copy()
            now[0] = i
            now += target != letter
            np.minimum(now, skipped, out=now)
            for _ in range(self.limit * MATCH // -GAP):
                np.minimum(now[1:], now[:-1] + self.kind(-GAP // MATCH), out=now[1:])
        return now

    def gapped(self, letters: bytes, cost: dict[bytes, np.ndarray], now: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """Least costs with gaps by end (index of the last target letter)."""
        now[:] = 0
        for i in range(len(letters)):
            np.add(now, 1 - GAP // MATCH, out=spare)  # this letter is skipped
            now[1:] = now[:-1].copy()
            now[0] = i
            now += cost[letters[i : i + 1]]
            np.minimum(now, spare, out=now)
            for _ in range(self.limit * MATCH // -GAP):  # target letters are skipped
                np.add(now, -GAP // MATCH, out=spare)
                np.minimum(now[1:], spare[:-1], out=now[1:])
        return now

    def in_lots(self, targets: list[np.ndarray], found: list[tuple[int, int]], chosen: list[int], step: Callable) -> None:
        """Runs a step on the chosen targets, about BUFFER letters at once, and sets what it finds."""
        lot, size = [], 0
        for i in chosen:
            lot.append(i)
            size += len(targets[i])
            if size >= self.BUFFER or i == chosen[-1]:
                best = [found[j] for j in lot]
                step([targets[j] for j in lot], best)
                for j, b in zip(lot, best, strict=True):
                    found[j] = b
                lot, size = [], 0

    def best(self, amplicons: list[str]) -> list[tuple[str | None, str | None, int | None, int | None, str | None]]:
        """(ProbeID, Probe_seq, mismatches, 0-based start, strand) of each amplicon's best probe."""
        targets = [codes(a or "") for a in amplicons]
        found: list[tuple[int, int]] = [(self.limit + 1, -1)] * len(targets)
        gap = -GAP // MATCH
        every = [i for i, t in enumerate(targets) if len(t)]
        self.in_lots(targets, found, every, self.looked_up)
        self.in_lots(targets, found, [i for i in every if found[i][0] > min(self.NEAR, self.limit)], lambda own, best: self.swept(own, best, False))
        settled = [c for c, _ in found]
        for low, high in ((gap, self.NEAR + 2), (self.NEAR + 2, 2 * gap)):
            self.in_lots(targets, found, [i for i in every if low <= settled[i] < high], self.with_one_gap)
        far = [i for i in every if 2 * gap <= settled[i]]
        for i in far:  # an earlier entry that is as good with gaps takes the place
            found[i] = min(found[i][0], self.limit) + 1, -1
        self.in_lots(targets, found, far, lambda own, best: self.swept(own, best, True))
        placed = [i for i, (_, number) in enumerate(found) if number >= 0]
        _, starts, _ = best_sites([(np.frombuffer(self.entries[found[i][1]][1], np.uint8), targets[i]) for i in placed])
        out: list[tuple] = [(None,) * 5] * len(targets)
        for i, start in zip(placed, starts.tolist(), strict=True):
            mismatches, number = found[i]
            probe, _, strand = self.entries[number]
            out[i] = *self.probes[probe], mismatches, max(0, start), strand
        return out


def by_prefix(probes: list[tuple[str, str]], limit: int, names: list[str | None], seqs: list[str | None]) -> list[tuple]:
    """(ProbeID, Probe_seq, mismatches, start, strand) of each amplicon's best probe of those that
    share its name's prefix, nulls without one within `limit`; all pairs are aligned together."""
    own: dict[str, list[tuple]] = {}
    for name, seq in probes:
        own.setdefault(name.split("|")[0], []).extend((name, seq, *entry) for entry in probe_entries(seq))
    pairs, rows, entries = [], [], []
    for i, (name, seq) in enumerate(zip(names, seqs, strict=True)):
        target = codes(seq or "")
        for entry in own.get((name or "").split("|")[0], []) if seq else []:
            pairs.append((entry[2], target))
            rows.append(i)
            entries.append(entry)
    cost, start, _ = best_sites(pairs)
    best: list[tuple] = [(None,) * 5] * len(seqs)
    for i, (name, seq, _, strand), c, s in zip(rows, entries, cost.tolist(), start.tolist(), strict=True):
        if c <= limit and (best[i][2] is None or c < best[i][2]):
            best[i] = name, seq, c, max(0, s), strand
    return best


def primer_sites(primers: list[str], amplicons: list[np.ndarray], end: int = 2) -> list[tuple[int, int]]:
    """(mismatches, unmatched among the last `end` letters) of each primer's best variant on its
    amplicon; the first of equally good variants counts. All are aligned together."""
    pairs, rows = [], []
    for i, (primer, target) in enumerate(zip(primers, amplicons, strict=True)):
        for variant in expanded(primer):
            pairs.append((codes(variant), target))
            rows.append(i)
    cost, _, unmatched = best_sites(pairs, end)
    best: list[tuple[int, int]] = [(-1, 0)] * len(primers)
    for i, c, u in zip(rows, cost.tolist(), unmatched.tolist(), strict=True):
        if best[i][0] < 0 or c < best[i][0]:
            best[i] = c, u
    return best


def primer_site(primer: str, amplicon: str, end: int = 2) -> tuple[int, int]:
    """primer_sites of one primer on one amplicon."""
    return primer_sites([primer], [codes(amplicon)], end)[0]


def align_probes(amplicons: DataFrame, probes: DataFrame, limit: int = 3, mux: bool = False) -> DataFrame:
    """Amplicons with ProbeID, Probe_seq, Probe_mismatches, Probe_startOnAmplicon and
    ProbeStrand of their best probe; nulls where none is within `limit` mismatches.

    A probe belongs to an amplicon if the prefixes of its id and of FP_ID are equal; with mux
    every probe is tried (see Panel). probes (id, seq) are a panel, sent along as a broadcast value.
    """
    panel = [(r["id"], r["seq"]) for r in probes.orderBy("id").limit(MOST_PROBES + 1).collect()]
    if len(panel) > MOST_PROBES:
        raise ValueError(f"more than {MOST_PROBES} probes")
    shared = amplicons.sparkSession.sparkContext.broadcast(panel)
    kind = "ProbeID string, Probe_seq string, Probe_mismatches int, Probe_startOnAmplicon int, ProbeStrand string"

    @F.pandas_udf(kind)
    def aligned(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        whole = Panel(shared.value, limit) if mux else None
        for names, seqs in batches:
            out = whole.best(seqs.tolist()) if whole else by_prefix(shared.value, limit, names.tolist(), seqs.tolist())
            yield pd.DataFrame(out, columns=[c.split()[0] for c in kind.split(", ")]).astype({"Probe_mismatches": "Int32", "Probe_startOnAmplicon": "Int32"})

    out = amplicons.withColumn("__probe", aligned(F.col("FP_ID"), F.col("AmpliconSeq")))
    return out.select(*amplicons.columns, "__probe.*")


def realign_primers(amplicons: DataFrame, limit: int = 3, end_mismatches: int = 0) -> DataFrame:
    """Amplicons whose primers, degenerate letters expanded, match within `limit`: the forward
    one on the amplicon, the reverse one on its complement, with at most `end_mismatches` among
    their last two letters. FP_mismatches and RP_mismatches are set anew."""
    kind = "FP_mismatches int, FP_end int, RP_mismatches int, RP_end int"

    @F.pandas_udf(kind)
    def realigned(fps: pd.Series, rps: pd.Series, seqs: pd.Series) -> pd.DataFrame:
        plus, minus = [codes(s or "") for s in seqs], [codes(complemented(s or "")) for s in seqs]
        f, r = primer_sites([x or "" for x in fps], plus), primer_sites([x or "" for x in rps], minus)
        return pd.DataFrame([(*a, *b) for a, b in zip(f, r, strict=True)], columns=[c.split()[0] for c in kind.split(", ")])

    out = amplicons.withColumn("__site", realigned("FP_seq", "RP_seq", "AmpliconSeq"))
    site = F.col("__site")
    ok = (site.FP_mismatches <= limit) & (site.RP_mismatches <= limit) & (site.FP_end <= end_mismatches) & (site.RP_end <= end_mismatches)
    kept = [c for c in amplicons.columns if c not in ("FP_mismatches", "RP_mismatches")]
    return out.filter(ok).select(*kept, site.FP_mismatches.alias("FP_mismatches"), site.RP_mismatches.alias("RP_mismatches"))
