"""SimHash near-duplicates: fingerprints, links by a generalised pigeonhole, components.

Fingerprint: words of the text (A-Z lower-cased) form shingles of ``SHINGLE`` words, repeats
included; fewer words make one shingle, none give fingerprint zero. A bit is 1 if it is set in over
half of the shingles' XXH64 hashes. Two fingerprints link at ``RADIUS`` or fewer differing bits.

Links: the 64 bits are dealt into ``m`` partitions, correlated bits together. Partition i gets a
threshold ``t_i >= -1`` with ``sum(t_i + 1) = RADIUS + 1``: two fingerprints within ``RADIUS`` must
be within ``t_i`` on some partition, or they would differ in more bits than they do. Dynamic
programming picks thresholds and ``m`` by estimated rows and candidates, so that a partition of
crowded values gets a small threshold or none. The estimate is made from ``SAMPLE`` fingerprints;
it only chooses the plan, links are exact under any plan. Every fingerprint probes the values
within ``t_i`` of its own; members of a bucket are verified, and a bucket emits links that span its
components, at most one per member, never all its pairs.

Scale: equal fingerprints collapse to one row first, so copies cost nothing. A bucket of more than
``CROWD`` fingerprints is not verified as it is: its members go through a finer scheme, 8 partitions
of 8 bits of which 5 must agree, with 40-bit keys. Components are found by star contraction.

Null texts are empty. Null ids never become a component's id (a component of null ids only has a
null id). Repeated rows get equal results; ties cannot occur; very long texts are hashed whole, alone
in their slice; further columns of any name are not read; an empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.llm import words
from voxloom.llm.components import roots, written
from voxloom.session import ship_package

SHINGLE = 3
SEED = 42
RADIUS = 3
SAMPLE = 4096
CROWD = 4096
#: Cost of shuffling and sorting a probe row, in verified pairs.
ROW_COST = 150
PAIRS_AT_ONCE = 1 << 22

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"): ord("Z") + 1] += 32


def _shingle_hashes(texts: words.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number of shingles of each row)."""
    joined, begin = texts.joined(table=_LOWER)
    raw = joined.tobytes()
    counts = np.diff(texts.doc_first)
    shingles = np.where(counts == 0, 0, np.maximum(counts - SHINGLE + 1, 1))
    first = np.concatenate([np.arange(a, a + n) for a, n in zip(texts.doc_first[:-1], shingles, strict=True)]
                           or [np.zeros(0, np.int64)])
    last = np.minimum(first + SHINGLE, np.repeat(texts.doc_first[1:], shingles))
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin[first].tolist(), (begin[last] - 1).tolist(),
                                                               strict=True)), np.uint64, len(first)), shingles


def fingerprint_rows(texts: words.Texts) -> np.ndarray:
    """The fingerprint of each row, as signed 64-bit integers."""
    hashes, shingles = _shingle_hashes(texts)
    ones = np.zeros((len(shingles), 64), dtype=np.int64)
    ends = np.cumsum(shingles)
    for i in range(0, len(hashes), 1 << 16):  # bits of some shingles at a time
        bits = np.unpackbits(hashes[i: i + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        row = np.searchsorted(ends, np.arange(i, i + len(bits)), side="right")
        first = np.flatnonzero(np.diff(row, prepend=-1))
        ones[row[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    packed = np.packbits(ones * 2 > shingles[:, None], axis=1, bitorder="little")
    return packed.view(np.uint64).ravel().view(np.int64)


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp (a long) and the columns ``keep`` of every row, from its whole text."""
    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *keep)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")

    def run(batches):
        for batch in batches:
            parts = [fingerprint_rows(t) for t in words.slices(words.plain_column(batch, "text"))]
            yield pa.RecordBatch.from_arrays(
                [*(words.plain_column(batch, c) for c in ("doc_id", *keep)), pa.array(np.concatenate([np.zeros(0, np.int64), *parts]))],
                ["doc_id", *keep, "fp"])

    return rows.mapInArrow(run, f"{schema}, fp bigint")


def _partitions(bits: np.ndarray, m: int) -> list[list[int]]:
    """Deal 64 bits into m groups of equal size, correlated bits together."""
    spread = bits - bits.mean(0)
    norm = np.sqrt((spread * spread).sum(0))
    related = np.abs(spread.T @ spread) / np.maximum(np.outer(norm, norm), 1e-9)
    free, out = list(range(64)), []
    for k in range(m):
        size = len(free) // (m - k)
        group = [max(free, key=lambda b: related[b, free].sum())]
        while len(group) < size:
            group.append(max((b for b in free if b not in group), key=lambda b: related[b, group].sum()))
        free = [b for b in free if b not in group]
        out.append(group)
    return out


def plan(sample: np.ndarray, total: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of the cheapest partitioning and thresholds for ``total`` fingerprints."""
    sample = sample.view(np.uint64)
    bits = np.unpackbits(sample.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
    best = (math.inf, [])
    for m in range(2, radius + 2):
        groups = _partitions(bits, m) if len(sample) > 1 else [list(range(k, 64, m)) for k in range(m)]
        # table[s]: cheapest way to give the partitions so far thresholds with sum(t + 1) = s
        table = {0: (0.0, [])}
        for group in groups:
            mask = np.uint64(sum(1 << b for b in group))
            near = np.zeros(radius + 1)
            own = sample & mask
            for shift in range(1, min(len(own), 257)):  # pairs of the sample, each value with 256 others
                near += np.cumsum(np.bincount(np.bitwise_count(own ^ np.roll(own, shift)), minlength=65))[: radius + 1]
            share = (near + 1) / (len(own) * 256 + 1)
            grown: dict[int, tuple[float, list]] = {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, radius - used + 1):
                    probes = sum(math.comb(len(group), k) for k in range(t + 1))
                    more = total * probes * ROW_COST + total * total * share[t] if t >= 0 else 0.0
                    if cost + more < grown.get(used + t + 1, (math.inf,))[0]:
                        grown[used + t + 1] = (cost + more, [*chosen, (group, t)])
            table = grown
        best = min(best, table[radius + 1], key=lambda x: x[0])
    return [(group, t) for group, t in best[1] if t >= 0]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _probes(nodes: DataFrame, keys: list[tuple[list[int], int]]) -> DataFrame:
    """part, key, home, fp: the values within the threshold of each fingerprint's own."""
    def near(part: int, group: list[int], threshold: int):
        own = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << b for b in group))))
        flips = [_signed(sum(1 << b for b in flip)) for k in range(threshold + 1) for flip in combinations(group, k)]
        return F.transform(F.array(*map(F.lit, flips)), lambda flip: F.struct(
            F.lit(part).alias("part"), own.bitwiseXOR(flip).alias("key"), (flip == 0).alias("home")))

    rows = [near(part, group, threshold) for part, (group, threshold) in enumerate(keys)]
    return nodes.select(F.explode(F.concat(*rows)).alias("p"), "fp").select("p.*", "fp")


def _spanning(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among n members reduced to at most one per member, with the same components."""
    if len(a) < n:
        return a, b
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    member = np.flatnonzero(label != np.arange(n))
    return member, label[member]


def _verified(part: np.ndarray, key: np.ndarray, home: np.ndarray, fp: np.ndarray, radius: int):
    """Links within runs of equal (part, key); in a run, members at home stand first."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (part[1:] != part[:-1])
    end = np.append(np.flatnonzero(new)[1:], len(key))[np.cumsum(new) - 1]
    at = np.flatnonzero(home & (end - np.arange(len(key)) > 1))
    count = end[at] - at - 1
    done, total = 0, np.cumsum(count)
    while done < len(at):
        to = max(done + 1, int(np.searchsorted(total, (total[done - 1] if done else 0) + PAIRS_AT_ONCE, side="right")))
        a = np.repeat(at[done:to], count[done:to])
        first = np.cumsum(count[done:to]) - count[done:to]
        b = a + 1 + np.arange(len(a)) - np.repeat(first, count[done:to])
        near = np.bitwise_count(fp[a] ^ fp[b]) <= radius
        yield a[near], b[near]
        done = to


def _links(probes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """u, v: verified links of every bucket, spanning its components."""
    ship_package(probes.sparkSession)

    def emit(held):
        part, key, home, fp = (np.concatenate(c) for c in zip(*held, strict=True))
        fp = fp.view(np.uint64)
        found = list(_verified(part, key, home, fp, radius))
        a, b = (np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k in (0, 1))
        a, b = _spanning(a, b, len(fp))
        return pa.RecordBatch.from_arrays([pa.array(fp[a].view(np.int64)), pa.array(fp[b].view(np.int64))], ["u", "v"])

    def run(batches):
        held = []  # whole buckets, and at the end one that may go on in the next batch
        for batch in batches:
            if not len(batch):
                continue
            columns = [words.plain_column(batch, c).to_numpy(zero_copy_only=False) for c in ("part", "key", "home", "fp")]
            part, key = columns[:2]
            change = np.flatnonzero((key != key[-1]) | (part != part[-1]))
            cut = int(change[-1]) + 1 if len(change) else 0
            if cut or held and (held[-1][0][-1], held[-1][1][-1]) != (part[0], key[0]):
                yield emit([*held, [c[:cut] for c in columns]])
                held = []
            held.append([c[cut:] for c in columns])
        if held:
            yield emit(held)

    ordered = probes.repartition("part", "key").sortWithinPartitions("part", "key", F.desc("home"))
    return ordered.mapInArrow(run, "u long, v long")


def links(nodes: DataFrame, crowd: int = CROWD, radius: int = RADIUS) -> DataFrame:
    """u, v: links that span every component of the distinct fingerprints ``nodes`` (fp)."""
    total = nodes.count()
    sample = np.array([r["fp"] for r in nodes.orderBy(F.xxhash64("fp"), "fp").limit(SAMPLE).collect()], dtype=np.int64)
    probes = _probes(nodes, plan(sample, total, radius))
    crowded = written(probes.groupBy("part", "key").agg(F.count("*").alias("n")).filter(F.col("n") > crowd)
                      .select("part", "key"), "crowded")
    if crowded.isEmpty():
        return _links(probes, radius)
    rest = _links(probes.join(crowded, ["part", "key"], "left_anti"), radius)
    members = written(probes.join(crowded, ["part", "key"], "left_semi").select("fp").distinct(), "members")
    eighths = [list(range(k, k + 8)) for k in range(0, 64, 8)]
    finer = [(sum(pick, []), 0) for pick in combinations(eighths, 8 - radius)]
    return rest.union(_links(_probes(members, finer), radius))


def _classes(docs: DataFrame, crowd: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, fp, root (smallest fingerprint of the component), component_id and ``keep`` of every row."""
    prints = written(fingerprints(docs, keep), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "nodes")
    root = roots(links(nodes.select("fp"), crowd)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    classes = nodes.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(classes.join(least, "root").select("fp", "root", "component_id"), "fp")


def near_duplicates(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id of every row of ``docs``."""
    return _classes(docs, crowd).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, crowd: int = CROWD) -> DataFrame:
    """One row of each component, all columns: of its rows with its smallest id, the one with the
    smallest hash of the text, then of all columns.

    A row counts by its own fingerprint: two different texts under one id both stay where each is
    the first of its component. Rows without id take no part and stay as they are.
    """
    text, row = "_first_text", "_first_row"
    named = docs.filter("doc_id is not null").withColumns(
        {text: F.xxhash64(F.coalesce("text", F.lit(""))), row: F.xxhash64(*docs.columns)})
    firsts = (_classes(named, crowd, (text, row)).filter("doc_id = component_id")
              .groupBy("root").agg(F.min(F.struct("doc_id", text, row)).alias("of")).select("of.doc_id", f"of.{row}"))
    # Rows that agree in every column are alike; one of them stays.
    kept = named.join(firsts, ["doc_id", row], "left_semi").dropDuplicates(["doc_id", row])
    return kept.select(docs.columns).unionByName(docs.filter("doc_id is null"))
