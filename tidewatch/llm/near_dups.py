"""MinHash near-duplicates with sequential Bayesian verification.

Texts with equal shingle sets form a class; its smallest doc_id stands for it. Signatures of 128 minima are banded,
4 to a band: two sets of similarity 0.75 share none of 32 bands with probability 5e-6. Candidates of a band bucket are
compared batch of signature by batch; a pair is dropped as soon as the posterior probability (uniform prior) that its
similarity reaches the threshold falls below ``miss``. Survivors are verified on their full shingle sets.

Within a bucket not every pair is made. First ``hub_rounds`` times one member, the hub, is compared with all that are
not yet known to be connected with it. Then buckets still holding several components are searched to the end: the
hub's component against the rest, and the rest against itself, in blocks of bounded size; pairs whose components are
already joined, or that an earlier band has in hand, are skipped. A group of copies so costs about one comparison per
member, and no link between components can be missed within the buckets.

Defined results: a text without words (or null) is linked with nothing; fewer words than a shingle count as one
shingle; a row with a null doc_id joins no component (null) and is kept; rows that share a doc_id are one document with
several texts, linked by any of them, and each row is told the component of its own text's class; an empty table gives
no rows; other columns are ignored. Similarity is compared in whole
numbers: 100 * intersection >= 75 * union.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import lean
from tidewatch.llm.components import components
from tidewatch.llm.shingles import MinHash, mix, shingle_sets
from tidewatch.session import discard, materialise

HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
BATCH = 16
PERCENT = 75
MISS = 1e-6
#: A block of a bucket holds about so many shingles, and so many texts at most on average.
BLOCK_SHINGLES, BLOCK_TEXTS = 300_000, 1024


def least_matches(miss: float = MISS, percent: int = PERCENT) -> list[int]:
    """For 16, 32, ... compared minima: the fewest matches at which a pair may still reach the threshold.

    With a uniform prior the posterior is Beta(m + 1, n - m + 1); its tail above t is the chance of at most m successes
    in n + 1 draws of probability t.
    """
    t, out = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append(m)
    return out


def _parts(batch: pd.DataFrame, column: str, most: int = 1 << 20) -> Iterator[pd.DataFrame]:
    """A batch in parts of about ``most`` characters, so that long texts do not pile up."""
    sizes = batch[column].str.len().fillna(0).to_numpy()
    part = (np.cumsum(sizes) // most).astype(int)
    for _, rows in batch.groupby(part, sort=False):
        yield rows


def signatures(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """(doc_id, n_shingles, k1, k2, sig): set size, two independent 64-bit sums over the set, the signature's bytes.

    Rows without a doc_id have null ``doc_id`` here too; ``with_text`` hands the text through.
    """
    extra = ["text"] if with_text else []

    @lean
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for rows in _parts(batch, "text"):
                sets = shingle_sets(list(rows["text"]))
                sig = MinHash(HASHES).signatures(sets)
                sums = [np.array([mix(s ^ np.uint64(c)).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64) for c in (0x51, 0xA3C59AC2F0E1)]
                found = {"has_id": rows["has_id"].to_numpy(), "doc_id": rows["doc_id"].to_numpy(), "n_shingles": [len(s) for s in sets], "k1": sums[0], "k2": sums[1], "sig": [r.tobytes() for r in sig]}
                yield pd.DataFrame(found | {c: rows[c].to_numpy() for c in extra})

    # pandas has no null in a column of whole numbers: the flag keeps ids exact.
    source = docs.select(F.col("doc_id").isNotNull().alias("has_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = source.mapInPandas(run, "has_id boolean, doc_id long, n_shingles long, k1 long, k2 long, sig binary" + ", text string" * with_text)
    return out.select(F.when(F.col("has_id"), F.col("doc_id")).alias("doc_id"), "n_shingles", "k1", "k2", "sig", *extra)


def _minima(packed: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(packed), np.uint32).reshape(-1, HASHES)


def may_reach(a: np.ndarray, b: np.ndarray, least: list[int]) -> np.ndarray:
    """Rows of two signature matrices that survive every batch."""
    alive, matches = np.arange(len(a)), np.zeros(len(a), np.int64)
    for k, need in enumerate(least):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (a[alive, part] == b[alive, part]).sum(1)
        keep = matches >= need
        alive, matches = alive[keep], matches[keep]
    return alive


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sorted shingle sets reach the threshold."""
    small, large = (a, b) if len(a) < len(b) else (b, a)
    if not len(small) or 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def verified(pairs: DataFrame, texts: DataFrame, miss: float = MISS) -> DataFrame:
    """Of ``pairs`` (a, b) those that reach the threshold; ``texts`` is (rep, sig, text)."""
    least = least_matches(miss)

    @lean
    def prune(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            if len(x):
                yield x.iloc[may_reach(_minima(x["sa"]), _minima(x["sb"]), least)][["a", "b"]]

    @lean
    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            for rows in _parts(x, "ta"):
                first = rows.drop_duplicates("a")
                of = dict(zip(first["a"], shingle_sets(list(first["ta"])), strict=True))
                ok = [linked(of[a], s) for a, s in zip(rows["a"], shingle_sets(list(rows["tb"])), strict=True)]
                yield rows.loc[ok, ["a", "b"]]

    side = lambda column, name, end: texts.select(F.col("rep").alias(end), F.col(column).alias(name))
    signed = pairs.join(side("sig", "sa", "a"), "a").join(side("sig", "sb", "b"), "b")
    near = signed.select("a", "b", "sa", "sb").mapInPandas(prune, "a long, b long")
    read = near.join(side("text", "ta", "a"), "a").join(side("text", "tb", "b"), "b")
    return read.select("a", "b", "ta", "tb").mapInPandas(verify, "a long, b long")


def buckets(reps: DataFrame) -> DataFrame:
    """(bucket, band, rep, n) for band buckets of two or more; ``reps`` is (rep, n, sig)."""
    width = 4 * ROWS
    bands = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.struct(i.alias("band"), F.xxhash64(F.substring(F.col("sig"), i * width + 1, F.lit(width)), i).alias("bucket")))
    dealt = reps.select("rep", "n", F.explode(bands).alias("x")).select("rep", "n", "x.band", "x.bucket")
    shared = dealt.groupBy("bucket").agg(F.count("*").alias("__n")).where("__n > 1").select("bucket")
    return dealt.join(shared, "bucket").select("bucket", "band", "rep", "n")


def _unresolved(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with their component, of buckets that hold several components."""
    if labels is None:
        return members.withColumn("component", F.col("rep"))
    known = labels.select(F.col("node").alias("rep"), "component")
    told = members.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    open_ = told.groupBy("bucket").agg(F.min("component").alias("__lo"), F.max("component").alias("__hi"), F.count("*").alias("__n"))
    # A bucket of two has had its only pair compared in the first round.
    return told.join(open_.where("__lo < __hi AND __n > 2").select("bucket"), "bucket")


def hub_pairs(members: DataFrame, round_: int) -> DataFrame:
    """(a, b): each bucket's hub and the members outside its component."""
    order = F.col("rep") if round_ == 0 else F.xxhash64("rep", F.lit(round_))
    hub = members.groupBy("bucket").agg(F.min_by(F.struct("rep", "component"), order).alias("hub"))
    met = members.join(hub, "bucket").where(F.col("component") != F.col("hub.component"))
    return met.select(F.least("rep", "hub.rep").alias("a"), F.greatest("rep", "hub.rep").alias("b")).distinct()


def rest_links(members: DataFrame, texts: DataFrame, miss: float = MISS) -> DataFrame:
    """Links (a, b) that join components of the same bucket, found by searching every open bucket to the end.

    A bucket's members are its hub's component (main) and the rest; both are dealt into blocks by hash, and each block of
    the rest meets every block of the rest from its own on, and every main block, in a group of its own.
    """
    least = least_matches(miss)
    hub = members.groupBy("bucket").agg(F.min_by("component", "rep").alias("__hub"))
    split = members.join(hub, "bucket").withColumn("rest", F.col("component") != F.col("__hub"))
    share = lambda side: F.ceil(F.greatest(
        F.coalesce(F.sum(F.when(side, F.col("n"))), F.lit(0)) / BLOCK_SHINGLES, F.count(F.when(side, 1)) / BLOCK_TEXTS)).cast("int")
    blocks = split.groupBy("bucket").agg(share(F.col("rest")).alias("__rests"), share(~F.col("rest")).alias("__mains"))
    placed = split.join(blocks, "bucket")
    own = F.pmod(F.xxhash64("rep", F.lit(11)), F.when(F.col("rest"), F.col("__rests")).otherwise(F.col("__mains"))).cast("int")
    placed = placed.withColumn("__own", own)
    # Group (i, j): rest block i with rest block j >= i; main block m rides along as j = rests + m. One group if all fit.
    i_all = F.sequence(F.lit(0), F.col("__rests") - 1)
    single = (F.col("__rests") == 1) & (F.col("__mains") == 1)
    as_first = F.transform(F.sequence(F.col("__own"), F.col("__rests") + F.col("__mains") - 1), lambda j: F.struct(F.col("__own").alias("i"), j.alias("j")))
    as_second = F.transform(F.filter(i_all, lambda i: i < F.col("__own")), lambda i: F.struct(i.alias("i"), F.col("__own").alias("j")))
    as_main = F.transform(i_all, lambda i: F.struct(i.alias("i"), (F.col("__rests") + F.col("__own")).alias("j")))
    lone = F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))
    groups = F.when(single, lone).when(F.col("rest"), F.concat(as_first, as_second)).otherwise(as_main)
    dealt = placed.select("bucket", "band", "rep", "component", "rest", "__rests", single.alias("__single"), F.explode(groups).alias("g"))
    # Which of a group's rest rows are searched from: block i; a row of another rest block only answers.
    dealt = dealt.withColumn("asks", F.col("rest") & (F.col("__single") | (F.pmod(F.xxhash64("rep", F.lit(11)), F.col("__rests")) == F.col("g.i"))))
    rows = dealt.select("bucket", "g.i", "g.j", "band", "rep", "component", "asks").join(texts, "rep")

    def search(x: pd.DataFrame) -> pd.DataFrame:
        return _search(x, least)

    found = rows.select("bucket", "i", "j", "band", "rep", "component", "asks", "sig", "text").groupBy("bucket", "i", "j").applyInPandas(search, "a long, b long")
    return found.distinct()


def _search(x: pd.DataFrame, least: list[int]) -> pd.DataFrame:
    x = x.sort_values("rep", ignore_index=True)
    sig, band, rep = _minima(x["sig"]), int(x["band"].iloc[0]), x["rep"].to_numpy()
    _, label = np.unique(x["component"].to_numpy(), return_inverse=True)
    # Bands before this one have the pair in hand if they agree.
    earlier = sig[:, : band * ROWS].reshape(len(x), band, ROWS)
    sets: dict[int, np.ndarray] = {}

    def of(k: int) -> np.ndarray:
        if k not in sets:
            sets[k] = shingle_sets([x["text"].iloc[k]])[0]
        return sets[k]

    out = []
    asks = x["asks"].to_numpy()
    for u in np.flatnonzero(asks):
        others = np.flatnonzero(label != label[u])
        others = others[~asks[others] | (others > u)]
        if not len(others):
            continue
        if band:
            others = others[~(earlier[others] == earlier[u]).all(2).any(1)]
        alive = others[may_reach(sig[others], np.broadcast_to(sig[u], (len(others), HASHES)), least)]
        for v in alive:
            if label[v] != label[u] and linked(of(u), of(v)):
                out.append((min(rep[u], rep[v]), max(rep[u], rep[v])))
                label[label == label[v]] = label[u]
    return pd.DataFrame(out, columns=["a", "b"], dtype="int64")


def near_duplicates(docs: DataFrame, hub_rounds: int = 2, miss: float = MISS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): one row per row of ``docs`` (``doc_id``, ``text``)."""
    signed = materialise(signatures(docs), "dups-signed")
    classes = signed.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min_by("sig", "doc_id").alias("sig"))
    classes = materialise(classes, "dups-classes")
    members = materialise(buckets(classes.select("rep", F.col("n_shingles").alias("n"), "sig")), "dups-buckets")
    # Only texts that share a bucket are read again; equal rows count once.
    wanted = docs.join(members.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    texts = signatures(wanted, with_text=True).dropDuplicates(["doc_id", "k1", "k2"]).select(F.col("doc_id").alias("rep"), "sig", "text")
    texts = materialise(texts, "dups-texts")
    links, labels = None, None
    for round_ in range(hub_rounds):
        found = verified(hub_pairs(_unresolved(members, labels), round_), texts, miss)
        links = materialise(found if links is None else links.union(found), "dups-links")
        labels = components(links)
    links = materialise(links.union(rest_links(_unresolved(members, labels), texts, miss)), "dups-links")
    # Every link is written: candidates and their texts are not needed any more.
    discard(docs.sparkSession, members, texts)
    labels = components(links)
    named = classes.join(labels, classes["rep"] == labels["node"], "left").select("k1", "k2", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
    known = signed.select("doc_id", "n_shingles", "k1", "k2").join(named, ["k1", "k2", "n_shingles"], "left")
    out = known.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("component_id").isNull() | (F.col("doc_id") == F.col("component_id")))


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group, that of smallest doc_id, equal rows once; rows without a doc_id stay."""
    kept = near_duplicates(docs.select("doc_id", "text")).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    named = docs.join(kept, "doc_id", "left_semi").withColumn("__text", F.xxhash64("text")).dropDuplicates(["doc_id", "__text"]).drop("__text")
    return named.unionByName(docs.where("doc_id IS NULL"))
