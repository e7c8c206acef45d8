"""Licence scans: ordered signature rules behind a keyword prefilter.

A text's lower-case words are first searched for every rule's keyword (a plain substring search); only rules whose
keyword is there run their pattern. Detections are word intervals. A detection inside another of the same or a
higher priority is suppressed; of equal intervals with equal priority the earlier rule stays. Everything happens inside
the row: no shuffle, and a text full of notices costs one sort and one sweep.

Defined results: a null text is empty; an empty text has no words, no labels and score 0; repeated rows are scanned each
for itself; an empty table gives no rows; input columns named like an added one are replaced. Only A-Z are lower-cased.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import text_of, without
from tidewatch.llm.license_rules import Rule, rules

#: ASCII characters that stand in no word, and what each ASCII character becomes: separators a space, A-Z lower case.
SEPARATORS = "".join(c for c in map(chr, range(128)) if not c.isalnum())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Phrases whose places are reported for themselves, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: How sure a detection of a priority is.
CERTAINTY = {1: 1.0, 2: 0.95, 3: 0.7, 4: 0.4}
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "detections", "labels", "score")


def words_of(text: Column) -> Column:
    """Lower-case words: runs of ASCII letters and digits and of anything beyond ASCII."""
    return F.array_remove(F.split(F.translate(text, SEPARATORS + UPPER, " " * len(SEPARATORS) + LOWER), " "), "")


def keywords_in(line: Column, table: list[Rule]) -> Column:
    """The prefilter: which rules' keywords start somewhere in the line. Short literals, so a plain substring search."""
    known = F.array(*[F.lit(k) for k in sorted({r.keyword for r in table} | {p for p, _ in BASE})])
    return F.filter(known, lambda k: F.contains(line, F.concat(F.lit(" "), k)))


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def places(line: Column, pattern: Column) -> Column:
    """Word intervals [start, end) at which a pattern of whole words matches."""
    whole = F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))
    gaps, hits = F.split(line, whole), F.regexp_extract_all(line, whole, F.lit(0))
    pairs = F.arrays_zip(F.transform(gaps, _spaces).alias("g"), F.transform(hits, _spaces).alias("h"))
    start = F.struct(F.lit(-1).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("out"))

    def step(s: Column, x: Column) -> Column:
        first = s["at"] + x["g"]
        stop = first + x["h"]
        one = F.array(F.struct(first.alias("start"), (stop + 1).alias("stop")))
        return F.struct(F.coalesce(stop, first).alias("at"), F.when(x["h"].isNotNull(), F.concat(s["out"], one)).otherwise(s["out"]).alias("out"))

    return F.aggregate(pairs, start, step, lambda s: s["out"])


def _table(found: list[Rule]) -> Column:
    """The rules as one constant."""
    rows = [{"rank": i, "label": r.label, "priority": r.priority, "keyword": r.keyword, "pattern": r.pattern, "rule": r.id} for i, r in enumerate(found)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<rank:int,label:string,priority:int,keyword:string,pattern:string,rule:string>>")


def detections(line: Column, keywords: Column, table: list[Rule]) -> Column:
    """What is left of all rules' detections after suppression: array of (start, stop, priority, rank, label, rule)."""
    run = F.filter(_table(table), lambda r: F.array_contains(keywords, r["keyword"]))
    found = F.flatten(F.transform(run, lambda r: F.transform(places(line, r["pattern"]), lambda p: F.struct(
        p["start"].alias("start"), (-p["stop"]).alias("neg"), r["priority"].alias("priority"), r["rank"].alias("rank"), r["label"].alias("label"), r["rule"].alias("rule")))))
    levels = max(CERTAINTY)
    # In order of start, then longest, then priority and rank, a detection lies inside an earlier one of its priority or
    # better if any of those reaches its end. A better one of the very same interval stands before it as well.
    kind = "struct<start:int,neg:int,priority:int,rank:int,label:string,rule:string>"
    start = F.struct(F.array_repeat(F.lit(-1), levels).alias("reach"), F.array().cast(f"array<{kind}>").alias("out"))

    def step(s: Column, d: Column) -> Column:
        end = -d["neg"]
        inside = F.exists(F.slice(s["reach"], F.lit(1), d["priority"]), lambda r: r >= end)
        reach = F.transform(s["reach"], lambda r, i: F.when(i + 1 == d["priority"], F.greatest(r, end)).otherwise(r))
        return F.when(inside, s).otherwise(F.struct(reach.alias("reach"), F.concat(s["out"], F.array(d)).alias("out")))

    return F.aggregate(F.sort_array(found), start, step, lambda s: s["out"])


def scan(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, the base places (``n_base``, ``first_word``, ``last_word``, ``base_labels``), the
    surviving ``detections``, all ``labels`` and a ``score``: the best detection's certainty."""
    table = rules() if table is None else table
    gated = without(docs, *ADDED, "__words", "__line", "__keys", "__base").withColumn("__words", words_of(text_of(docs)))
    gated = gated.withColumn("n_words", F.size("__words").cast("long")).withColumn("__line", F.concat(F.lit(" "), F.array_join("__words", " "), F.lit(" ")))
    gated = gated.withColumn("__keys", keywords_in(F.col("__line"), table))
    gate = F.size("__keys") > 0
    base = F.array(*[F.struct(F.lit(label).alias("label"), places(F.col("__line"), F.lit(phrase)).alias("at")) for phrase, label in BASE])
    kind = "array<struct<start:int,neg:int,priority:int,rank:int,label:string,rule:string>>"
    seen = gated.withColumns({
        "__base": F.when(gate, F.filter(base, lambda b: F.size(b["at"]) > 0)).otherwise(F.array().cast("array<struct<label:string,at:array<struct<start:int,stop:int>>>>")),
        "detections": F.when(gate, detections(F.col("__line"), F.col("__keys"), table)).otherwise(F.array().cast(kind)),
    })
    starts = F.transform(F.flatten(F.transform("__base", lambda b: b["at"])), lambda p: p["start"])
    labels = F.transform("__base", lambda b: b["label"])
    sure = F.create_map(*[F.lit(x) for kv in CERTAINTY.items() for x in kv])
    best = F.array_max(F.transform("detections", lambda d: F.element_at(sure, d["priority"])))
    out = seen.withColumns({
        "n_base": F.size(starts).cast("long"), "first_word": F.array_min(starts).cast("long"), "last_word": F.array_max(starts).cast("long"),
        "base_labels": F.array_join(F.sort_array(F.array_distinct(labels)), ","),
        "labels": F.array_join(F.sort_array(F.array_distinct(F.concat(labels, F.transform("detections", lambda d: d["label"])))), ","),
        "score": F.greatest(F.coalesce(best, F.lit(0.0)), F.when(F.size(starts) > 0, F.lit(CERTAINTY[2])).otherwise(0.0)),
    })
    shown = F.transform("detections", lambda d: F.struct(d["start"].alias("start"), (-d["neg"]).alias("stop"), d["label"].alias("label"), d["priority"].alias("priority"), d["rule"].alias("rule")))
    return out.withColumn("detections", shown).drop("__words", "__line", "__keys", "__base")
