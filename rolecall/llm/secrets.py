"""Secret scan with a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams that each match
must hold. The index lists, for each trigram that some query asks for, the documents that
hold it; intersecting these postings gives a rule's candidates, and only their texts are
read again to verify. A rule without mandatory trigrams scans all texts. Everything runs as
built-in Spark expressions; only the few rules are handled in Python.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as sre, _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rolecall.llm.common import free, let


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of `pattern` whose `group` has `least` characters.

    The pattern must mean the same to Java and to Python.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules. A maximal run of at least 32 (AKIA and 12 more) characters
# is the same as a run whose length is checked afterwards.
BASE = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]{12,}"),
    Rule("hex", r"[0-9a-f]{32,}"),
]
# Public formats of keys and tokens.
MORE = [
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
]
RULES = [*BASE, *MORE]

MOST_STRINGS = 200  # an alternation of more strings counts as free text
MOST_BITS = 62

Clause = list[frozenset[str]]  # alternatives, each a set of trigrams


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all hold for the lower-cased text of a match; none: no trigram is needed."""
    clauses: list[Clause] = []

    def flush(strings: set[str]) -> None:
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
        if frozenset() in sets:
            return  # a string too short for a trigram
        least = [s for s in sets if not any(t < s for t in sets)]
        if least not in clauses:
            clauses.append(sorted(least, key=sorted))

    def finite(items) -> set[str] | None:
        """All strings that the items can match, lower-cased, or None for too many."""
        out = {""}
        for op, arg in items:
            if op is sre.LITERAL:
                own = {chr(arg).lower()}
            elif op is sre.IN:
                own = set()
                for kind, value in arg:
                    if kind is sre.LITERAL:
                        own.add(chr(value).lower())
                    elif kind is sre.RANGE and value[1] - value[0] < 8:
                        own |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
                    else:
                        return None
            elif op is sre.BRANCH:
                each = [finite(branch) for branch in arg[1]]
                if None in each:
                    return None
                own = set().union(*each)
            elif op is sre.SUBPATTERN:
                own = finite(arg[3])
            elif op is sre.MAX_REPEAT and arg[1] != sre.MAXREPEAT and arg[1] <= 4:
                one = finite(arg[2])
                if one is None:
                    return None
                own = set()
                for n in range(arg[0], arg[1] + 1):
                    own |= {"".join(p) for p in product(one, repeat=n)}
            else:
                return None
            if own is None or len(out) * len(own) > MOST_STRINGS:
                return None
            out = {a + b for a in out for b in own}
        return out

    def walk(items) -> None:
        strings = {""}
        for item in items:
            own = finite([item])
            if own is not None and len(strings) * len(own) <= MOST_STRINGS:
                strings = {a + b for a in strings for b in own}
                continue
            flush(strings)
            strings = {""} if own is None else own
            if own is None and item[0] is sre.SUBPATTERN:
                walk(item[1][3])
            elif own is None and item[0] is sre.MAX_REPEAT and item[1][0]:
                walk(item[1][2])
        flush(strings)

    walk(parser.parse(pattern, re.ASCII))
    return clauses


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def trigram_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (`trigram`, `doc_id`) of the trigrams that the queries use."""
    low = F.lower("text")
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in trigrams]))
    return _rows(docs).select("doc_id", F.explode(held).alias("trigram"))


def candidates(spark: SparkSession, index: DataFrame, rules: list[Rule]) -> DataFrame:
    """doc_id and `kinds`, the rules whose query its postings satisfy."""
    asked = []
    wanted = []
    for rule in rules:
        query = trigram_query(rule.pattern)
        wanted.append((rule.kind, (1 << len(query)) - 1))
        for part, clause in enumerate(query):
            for alt, grams in enumerate(clause):
                some = sorted(grams)[:MOST_BITS]
                for bit, gram in enumerate(some):
                    asked.append((rule.kind, part, alt, (1 << len(some)) - 1, 1 << bit, gram))

    def values(names: str, tuples: list[tuple]) -> DataFrame:
        structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names.split(), t)]) for t in tuples]
        return spark.range(1).select(F.inline(F.array(*structs)))

    # The rules bound the size of both broadcasts.
    ask = F.broadcast(values("kind part alt full bit trigram", [(k, p, a, f, b, g) for k, p, a, f, b, g in asked]))
    want = F.broadcast(values("kind parts", wanted))
    whole = (
        index.join(ask, "trigram")
        .groupBy("doc_id", "kind", "part", "alt", "full")
        .agg(F.bit_or(F.col("bit").cast("long")).alias("held"))
        .filter("held = full")
    )
    parts = whole.groupBy("doc_id", "kind").agg(
        F.bit_or(F.expr("shiftleft(1L, part)")).alias("met")
    )
    met = parts.join(want, "kind").filter("met = parts")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """Array of (start, rank, end, kind) of a rule's matches, in code points."""
    kind = "struct<start:bigint,rank:int,end:bigint,kind:string>"
    regex = F.lit(rule.pattern)
    pieces = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, regex, F.lit(0))
    values = F.regexp_extract_all(text, regex, F.lit(rule.group))
    none = F.array().cast(f"array<{kind}>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.char_length(x["piece"])
        end = begin + F.char_length(x["match"])
        own = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind")
        )
        out = F.when(F.char_length(x["value"]) >= rule.least, F.concat(acc["out"], F.array(own))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    # The last piece follows the last match; it has no match beside it and is left out.
    rows = F.filter(
        F.arrays_zip(pieces.alias("piece"), matches.alias("match"), values.alias("value")),
        lambda x: x["match"].isNotNull(),
    )
    found = F.aggregate(rows, start, step, lambda acc: acc["out"])
    return F.when(F.rlike(text, regex), found).otherwise(none)


def find_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id, text_key and `spans` of every row of `docs` (`doc_id`, `text`).

    `spans` is sorted by start, then rule order. Rows that repeat give a row each. A NULL or
    empty text has no spans; a NULL doc_id stays NULL; no rows give none. Other columns are
    not read. `text_key` is a hash of the text, for joining the spans back to it.
    """
    spark = docs.sparkSession
    rank = {rule.kind: i for i, rule in enumerate(rules)}
    queries = {rule.kind: trigram_query(rule.pattern) for rule in rules}
    indexed = [rule for rule in rules if queries[rule.kind]]
    scanned = [rule for rule in rules if not queries[rule.kind]]
    rows = _rows(docs).withColumn("text_key", F.xxhash64("text"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,kind:string>>")

    every = rows.select(
        "doc_id", "text_key", F.lit(1).cast("long").alias("n"),
        F.concat(none, *[spans(F.col("text"), r, rank[r.kind]) for r in scanned]).alias("found"),
    )
    parts = [every]
    if indexed:
        trigrams = sorted({t for r in indexed for clause in queries[r.kind] for s in clause for t in s})
        chosen = candidates(spark, trigram_index(docs, trigrams), indexed).withColumnRenamed("doc_id", "candidate")
        verified = rows.join(chosen, F.col("doc_id").eqNullSafe(F.col("candidate"))).select(
            "doc_id", "text_key", F.lit(0).cast("long").alias("n"),
            F.concat(
                none,
                *[
                    F.when(F.array_contains("kinds", r.kind), spans(F.col("text"), r, rank[r.kind])).otherwise(none)
                    for r in indexed
                ],
            ).alias("found"),
        )
        parts.append(verified.filter(F.size("found") > 0))
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # Equal rows have equal spans, so the sets stay small however often a row repeats.
    merged = both.groupBy("doc_id", "text_key").agg(
        F.sum("n").alias("n"), F.array_sort(F.flatten(F.collect_set("found"))).alias("spans")
    )
    return merged.select("doc_id", "text_key", "spans", F.explode(F.expr("sequence(1L, n)")).alias("_")).drop("_")


def redact(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """`docs` with every secret replaced by its kind in angle brackets, n_chars kept right.

    Of spans that overlap, the first one counts. NULL and empty texts, and texts without
    secrets, stay as they are; a NULL doc_id stays NULL; repeated rows are redacted each; no
    rows give none. Other columns, whatever their names, are kept.
    """
    found = find_secrets(docs, rules).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"])
    doc, key, own, cut = (free(docs, n) for n in ("_doc", "_key", "_spans", "_cut"))
    found = found.select(F.col("doc_id").alias(doc), F.col("text_key").alias(key), F.col("spans").alias(own))
    text = F.col("text")

    def step(acc: Column, s: Column) -> Column:
        before = F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        mark = F.concat(F.lit("<"), s["kind"], F.lit(">"))
        fresh = F.struct(s["end"].alias("at"), F.concat(acc["out"], before, mark).alias("out"))
        more = F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))
        return F.when(s["start"] >= acc["at"], fresh).otherwise(more)

    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(
        own, start, step,
        lambda acc: F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), F.char_length(text))),
    )
    same = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(key))
    joined = docs.join(found, same, "left")
    kept = F.when(F.col(own).isNull(), text).otherwise(clean)
    columns = [kept.alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    out = joined.select(*columns, F.col(own).isNotNull().alias(cut))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(cut), F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.drop(cut)


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of `find_secrets`."""
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))

    def text(of: Column) -> Column:
        return F.array_join(
            F.transform(of, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
        )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in BASE],
        F.sha2(text(base), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
