"""Secret scan through a trigram index.

Each rule is a regular expression from which a Boolean trigram query is derived. The index has a posting per trigram of
the queries and document; postings are intersected per alternative of a clause, and clauses per rule. Only candidates
are verified with the expression. Rules whose expressions have no mandatory trigram scan all texts.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.trigrams import trigram_query


class Rule(NamedTuple):
    """A kind of secret: expression, the group to measure, and the characters it must have at least."""

    kind: str
    pattern: str
    group: int
    min_chars: int


#: The expressions of the base rules, and well-known forms of keys.
RULES = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("private", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", r"AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]+", 0, 24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
]
BASE_KINDS = ("assign", "access", "hex")
_KEY = ["doc_id", "text_hash"]


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    text_column = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text_column).alias("text_hash"), text_column.alias("text"))


def postings(rows: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index of the given trigrams: trigram, doc_id, text_hash; one row per trigram and text that has it."""
    lowered = F.transform(F.array(F.lower("text")), lambda t: F.filter(
        F.array(*[F.lit(g) for g in trigrams]), lambda g: F.contains(t, g)))[0]
    return rows.select(*_KEY, F.explode(lowered).alias("trigram"))


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """Texts whose postings satisfy the query of a rule: doc_id, text_hash, rule (its number)."""
    needs = []
    for r, rule in enumerate(rules):
        for c, clause in enumerate(trigram_query(rule.pattern)):
            for a, alternative in enumerate(clause):
                needs += [(r, c, a, g, len(alternative)) for g in sorted(alternative)]
    clauses = {r: len(trigram_query(rule.pattern)) for r, rule in enumerate(rules)}
    wanted = index.sparkSession.createDataFrame(
        needs, "rule int, clause int, alternative int, trigram string, n_trigrams int").coalesce(1)
    n_clauses = F.create_map(*[F.lit(x) for pair in clauses.items() for x in pair])
    return (index.join(F.broadcast(wanted), "trigram")  # one row per trigram of the rules
            .groupBy(*_KEY, "rule", "clause", "alternative")
            .agg(F.countDistinct("trigram").alias("n"), F.first("n_trigrams").alias("n_trigrams"))
            .where("n = n_trigrams").groupBy(*_KEY, "rule").agg(F.countDistinct("clause").alias("n"))
            .where(F.col("n") == n_clauses[F.col("rule")]).select(*_KEY, "rule"))


def _matches(rule: Rule, number: int) -> Column:
    """All matches in order, leftmost and not overlapping: characters before, characters, and whether long enough."""
    value = rule.group
    found = F.arrays_zip(
        F.transform(F.split("text", rule.pattern, -1), lambda x: F.length(x)).alias("gap"),
        F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(0)), lambda x: F.length(x)).alias("size"),
        F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(value)), lambda x: F.length(x)).alias("value"))
    return F.transform(found, lambda x, i: F.struct(
        F.lit(number).alias("rule"), i.alias("pos"), x["gap"].alias("gap"), x["size"].alias("size"),
        (x["value"] >= rule.min_chars).alias("ok")))


def scan(docs: DataFrame, rules: list[Rule] = RULES, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id and its secrets, an array of (start, rule, end, kind) in that order.

    Positions are code points, ``end`` exclusive. Matches of one rule do not overlap, those of different rules may. Null
    and empty texts have none. Rows with the same id and text get the same secrets, each row its own; null ids are
    kept; other columns are left out; an empty table gives no rows.
    """
    rows = _keyed(docs, doc_id, text)
    indexed = [r for r, rule in enumerate(rules) if trigram_query(rule.pattern)]
    trigrams = sorted({g for r in indexed for clause in trigram_query(rules[r].pattern) for a in clause for g in a})
    some = candidates(postings(rows, trigrams), rules) if trigrams else None
    for r, rule in enumerate(rules):
        if r not in indexed:
            long_enough = f"(?:{rule.pattern[:-1]}{{{rule.min_chars},}})" if _is_run(rule) else rule.pattern
            hits = rows.where(F.col("text").rlike(long_enough)).select(*_KEY, F.lit(r).alias("rule"))
            some = hits if some is None else some.unionByName(hits)
    wanted = some.groupBy(*_KEY).agg(F.collect_set("rule").alias("rules"))
    right = wanted.select(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"), "rules")
    texts = (rows.join(right, rows["doc_id"].eqNullSafe(right["r_id"]) & (rows["text_hash"] == right["r_hash"]))
             .select(*_KEY, "text", "rules").dropDuplicates(_KEY))
    none = F.expr("cast(array() as array<struct<rule:int,pos:int,gap:int,size:int,ok:boolean>>)")
    matches = texts.select(*_KEY, F.explode(F.flatten(F.array(*[
        F.when(F.array_contains("rules", r), _matches(rule, r)).otherwise(none) for r, rule in enumerate(rules)]))
    ).alias("m")).select(*_KEY, "m.*").where("size is not null")
    upto = Window.partitionBy(*_KEY, "rule").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    kind = F.array(*[F.lit(rule.kind) for rule in rules])
    spans = (matches.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(upto).cast("int")).where("ok")
             .groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct(
                 (F.col("end") - F.col("size")).alias("start"), "rule", "end", F.get(kind, F.col("rule")).alias("kind"))))
                 .alias("secrets")))
    right = spans.select(F.col("doc_id").alias("r_id"), F.col("text_hash").alias("r_hash"), "secrets")
    keys = rows.select(*_KEY)
    return (keys.join(right, keys["doc_id"].eqNullSafe(right["r_id"]) & (keys["text_hash"] == right["r_hash"]), "left")
            .select("doc_id", F.coalesce("secrets", F.expr(
                "cast(array() as array<struct<start:int,rule:int,end:int,kind:string>>)")).alias("secrets")))


def _is_run(rule: Rule) -> bool:
    """Whether the expression is one character set repeated, so that too short runs can be told by the expression."""
    return rule.pattern.startswith("[") and rule.pattern.endswith("]+") and rule.pattern.count("]") == 1


def span_text(secrets: Column) -> Column:
    """Secrets as kind:start:end, joined by commas."""
    return F.array_join(F.transform(secrets, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
