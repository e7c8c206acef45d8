"""Main text by site style trees.

The DOMs of a host's pages are merged: elements with the same path of tags and class names are one node of the host's
tree. A node's presentations are the runs of block child elements it has on the pages, its contents the texts it holds
itself, inline elements included. Both are weighed by entropy over the pages that have the node: a node looking the same everywhere, or
holding the same text on most pages, is furniture; one whose texts belong to single pages matters.

    presentation = -sum p_i log(p_i) / log(m + c)             over presentations i
    content      = 1 - mean over texts of log(k) / log(m + c)  a text standing on k of the node's m pages
    composite    = (1 - g ** l) * presentation + g ** l * content              l block children of an element on average, g = 0.9
    importance   = max(content, composite) + prior * log(c) / log(m + c)

The layout around a text can speak for it, never against it: a text of single pages counts in full wherever it stands.
``c`` pages of doubt keep a host of few pages from condemning its articles. Text of nodes below ``threshold`` is removed.
``prior`` speaks for article and main elements and against elements that are furniture by tag or name on most sites; what
it weighs falls with the host's pages, so that entropy outvotes it on a host of many (173 for texts that all differ). It
ends at the next article or main element, and a name does not count where the elements of that path hold most of the
page's text: that is a wrapper of the page. Only the text of tags that never hold reading text (nav, footer, script and
the like) is left out whatever the host.

Every page is parsed once. Nodes are only counted per host, and a host's removed nodes go back to its pages by a join
that Spark can split, so one host may hold any share of the pages. Copies of a page count once.

Defined results: a null or empty page, or one with nothing left, has an empty text; a page without a host is judged by
the priors alone; repeated pages are kept as they are; an empty table gives no rows; input columns named like an added
one are replaced. Broken markup is read as far as it goes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewatch.llm import html_blocks
from tidewatch.llm.common import lean, text_slices, without
from tidewatch.session import materialise

INNER = ("__host", "__page", "__blocks", "__nodes")
_BLOCKS = T.ArrayType(T.StructType().add("path", T.LongType()).add("prior", T.DoubleType()).add("text", T.StringType()))
_NODES = T.ArrayType(T.StructType().add("path", T.LongType()).add("style", T.LongType()).add("children", T.DoubleType()))


def parsed(pages: DataFrame) -> DataFrame:
    """``pages`` without ``html``, with ``__host``, ``__page`` (a hash of it), ``__blocks`` (path, prior, text) and ``__nodes`` (path, presentation,
    block children of an element; one per path and page)."""
    kept = without(pages, "html", *INNER).withColumn("__page", F.lit(0).cast("long"))
    blocks = pa.list_(pa.struct([("path", pa.int64()), ("prior", pa.float64()), ("text", pa.string())]))
    nodes = pa.list_(pa.struct([("path", pa.int64()), ("style", pa.int64()), ("children", pa.float64())]))
    names = [*kept.columns, "__blocks", "__nodes"]

    @lean
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = lru_cache(100_000)(html_blocks.path_key)
        for whole in batches:
            for batch in text_slices(whole, 0):
                found, seen = [], []
                for html in batch.column(0).to_pylist():
                    b, children = html_blocks.parse_counted(html)
                    found.append([{"path": key(p), "prior": v, "text": t} for p, v, t in b])
                    seen.append([{"path": key(p), "style": key(">".join(k for k, _ in groupby(c))), "children": len(c) / n} for p, (c, n) in children.items()])
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(found, blocks), pa.array(seen, nodes)], names=names)

    shape = T.StructType(list(kept.schema.fields)).add("__blocks", _BLOCKS).add("__nodes", _NODES)
    html = pages["html"].cast("string")
    read = pages.select(html.alias("__html"), *[F.col(f"`{c}`") for c in kept.columns[:-1]], F.xxhash64(html).alias("__page")).mapInArrow(run, shape)
    host = F.regexp_extract(F.lower(F.col("url").cast("string")), r"^(?:[a-z][a-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return read.withColumn("__host", F.when(host != "", host))


def importances(read: DataFrame, doubt: int = 8, depth: float = 0.9) -> DataFrame:
    """(host, path, importance) of every node that holds text on some page of a host."""
    log = lambda pages: F.log(pages + doubt)
    pages = read.where("__host IS NOT NULL")
    once = lambda x: pages.select("__host", "__page", x.alias("x")).dropDuplicates(["__host", "__page"]).select("__host", F.explode("x").alias("x")).select("__host", "x.*")
    node = once(F.col("__nodes"))
    looks = node.groupBy("__host", "path", "style").agg(F.count("*").alias("__n"), F.sum("children").alias("__c"))
    shown = looks.groupBy("__host", "path").agg(F.sum("__n").alias("__m"), F.sum("__c").alias("__c"), F.sum(F.col("__n") * F.log("__n")).alias("__nlogn"))
    m = F.col("__m").cast("double")
    shown = shown.select("__host", "path", m.alias("__m"), (F.col("__c") / m).alias("__l"), ((F.log(m) - F.col("__nlogn") / m) / log(m)).alias("__presentation"))
    texts = F.array_distinct(F.transform("__blocks", lambda b: F.struct(b["path"].alias("path"), b["prior"].alias("prior"), F.xxhash64(b["text"]).alias("text"))))
    common = once(texts).groupBy("__host", "path", "text").agg(F.count("*").alias("__k"), F.sum("prior").alias("__priors"))
    content = common.groupBy("__host", "path").agg(F.avg(F.log("__k")).alias("__logk"), (F.sum("__priors") / F.sum("__k")).alias("prior"))
    both = content.join(shown, ["__host", "path"])
    weight = F.pow(F.lit(depth), F.col("__l"))
    own = 1 - F.col("__logk") / log(F.col("__m"))
    value = F.greatest(own, (1 - weight) * F.col("__presentation") + weight * own) + F.col("prior") * F.log(F.lit(float(doubt))) / log(F.col("__m"))
    return both.select(F.col("__host").alias("host"), "path", value.alias("importance"))


def extract(pages: DataFrame, threshold: float = 0.2) -> DataFrame:
    """``pages`` (``url``, ``html``, any others) without ``html``, with ``text`` and ``n_chars``."""
    read = materialise(parsed(without(pages, "text", "n_chars")), "pages-parsed")
    low = importances(read).where(F.col("importance") < threshold)
    low = materialise(low.groupBy("host").agg(F.collect_set("path").alias("__low")), "pages-low")
    judged = read.join(low, read["__host"] == low["host"], "left")
    gone = F.coalesce("__low", F.array().cast("array<long>"))
    main = F.filter("__blocks", lambda b: (F.col("__host").isNotNull() | (b["prior"] >= html_blocks.NEUTRAL)) & ~F.array_contains(gone, b["path"]))
    text = F.array_join(F.transform(main, lambda b: b["text"]), "\n")
    out = judged.withColumn("text", text).withColumn("n_chars", F.length("text").cast("long"))
    return out.drop(*INNER, "host", "__low")
