"""Personal data by bootstrapped contextual extraction (native DataFrame operations only).

Base rules find the seeds. The word before a seed is a lexical pattern; patterns and
the identifier-shaped values they extract form a bipartite graph, whose two sides score each
other for a few rounds: a pattern by how much of what it is followed by is known to be
personal data, a value by the patterns that extract it. Values of high score that the
base rules missed are reported too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanloom.llm.common import stored, whole_text

KINDS = ("email", "ip", "card", "phone")
#: The base rules, written so that they find the same matches in linear time and without
#: recursion: runs are possessive, and a run is entered at its start or after the last match.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Shapes of values that a pattern may extract; wider than the base rules.
SHAPE = {
    "email": r"[^\s@,;<>()\[\]]++(?:@|\(at\)|\[at\])[^\s@,;<>()]{2,}+",
    "ip": r"(?:[0-9]{1,3}[.,:-]){3}[0-9]{1,3}(?![0-9])|(?:[0-9A-Fa-f]{1,4}:){4,7}[0-9A-Fa-f]{1,4}",
    "card": r"[0-9]{4}(?:[\x20./-]?[0-9]{4}){2}[\x20./-]?[0-9]{1,7}(?![0-9])",
    "phone": r"\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,5}){2,4}(?![0-9])",
}
SPAN = "struct<start:int,end:int,value:string>"
#: Matches whose offsets are added up in one run.
BLOCK = 256


def located(text: Column, pattern: str) -> Column:
    """Matches of a pattern with code-point offsets (end exclusive), in order.

    The pieces between the matches and the matches themselves add up to the offsets.
    """
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), 0).alias("value")
    )
    none = F.array().cast(f"array<{SPAN}>")

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["value"])
        span = F.struct(begin.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def spans(pieces: Column, at: Column) -> Column:
        return F.aggregate(pieces, F.struct(at.alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])

    def blocks(pieces: Column) -> Column:
        """The same for many matches: in runs of BLOCK, as each step copies the spans of its run."""
        begins = F.sequence(F.lit(1), F.size(pieces), F.lit(BLOCK))
        runs = F.transform(begins, lambda b: F.slice(pieces, b, BLOCK))
        sizes = F.transform(runs, lambda r: F.aggregate(r, F.lit(0), lambda n, x: n + F.length(x["gap"]) + F.length(x["value"])))
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all"))
        places = F.aggregate(
            sizes, start, lambda acc, n: F.struct((acc["at"] + n).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")), lambda acc: acc["all"]
        )
        return F.flatten(F.transform(F.arrays_zip(runs.alias("run"), places.alias("at")), lambda z: spans(z["run"], z["at"])))

    real = F.filter(found, lambda x: x["value"].isNotNull())
    # An array of one value names it, so that the matches are found once.
    named = F.transform(F.array(real), lambda r: F.when(F.size(r) <= BLOCK, spans(r, F.lit(0))).otherwise(blocks(r)))
    return F.element_at(named, 1)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def passes_luhn(digits: Column) -> Column:
    places = F.sequence(F.lit(1), F.length(digits))

    def worth(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.transform(places, worth), F.lit(0), lambda a, d: a + d) % 10 == 0


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.coalesce(p.try_cast("bigint") <= 255, F.lit(False)))
    digits = _digits(value)
    if kind == "card":
        return F.length(digits).between(13, 19) & passes_luhn(digits)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def base_spans(text: Column, kind: str) -> Column:
    """Spans of one base rule; matches that fail its test are dropped and not tried again."""
    sign = {"email": "@", "phone": "+", "ip": "."}.get(kind)
    spans = F.filter(located(text, BASE[kind]), lambda s: _valid(kind, s["value"]))
    holds = F.contains(text, F.lit(sign)) if sign else F.rlike(text, F.lit("[0-9]"))
    return F.when(holds, spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def _mentions(text: Column, kind: str, base: dict[str, Column]) -> Column:
    """Values of a kind's shape with the word before them; ``seed`` where a base span covers them."""
    context = rf"(?<!\S)[^\s]++\s++(?:{SHAPE[kind]})"

    def mention(s: Column) -> Column:
        value = F.regexp_extract(s["value"], rf"^[^\s]++\s++((?:{SHAPE[kind]}))$", 1)
        begin = s["end"] - F.length(value)

        def covers(spans: Column) -> Column:
            return F.exists(spans, lambda b: (b["start"] < s["end"]) & (begin < b["end"]))

        other = F.lit(False)
        for k in KINDS:
            if k != kind:
                other = other | covers(base[k])
        return F.struct(
            F.lit(kind).alias("kind"),
            F.lower(F.regexp_extract(s["value"], r"^([^\s]+)", 1)).alias("pattern"),
            F.lower(value).alias("value"),
            begin.alias("start"),
            s["end"].alias("end"),
            covers(base[kind]).alias("seed"),
            (other & ~covers(base[kind])).alias("other"),
        )

    found = F.filter(F.transform(located(text, context), mention), lambda m: ~m["other"] & (m["value"] != ""))
    sign = "[@]|[(\\[]at[)\\]]" if kind == "email" else "[0-9]"
    return F.when(F.rlike(text, F.lit(sign)), found).otherwise(F.filter(found, lambda m: F.lit(False)))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def discovered(
    spark: SparkSession, docs: DataFrame, mentions: DataFrame, rounds: int = 3, support: int = 3, score: float = 0.5
) -> DataFrame:
    """Mentions (of the columns given) that confident patterns extract and no base rule found.

    A pattern's score is the summed score of the distinct values it extracts over the times
    its word occurs in texts that could hold an identifier, so words that stand anywhere
    prove nothing; it needs ``support`` distinct seeds. Both scores are kept in stored tables.
    """
    edges = mentions.groupBy("kind", "pattern", "value").agg(F.max(F.col("seed").cast("int")).alias("seed"), F.count(F.lit(1)).alias("times"))
    edges = stored(spark, edges, "edges")
    strong = edges.groupBy("kind", "pattern").agg(F.sum("seed").alias("seeds")).filter(F.col("seeds") >= support)
    words = docs.filter(F.rlike(whole_text(), F.lit("[0-9@]"))).select(F.explode(F.split(F.lower(whole_text()), r"\s+")).alias("pattern"))
    words = words.groupBy("pattern").agg(F.count(F.lit(1)).alias("occurs"))
    patterns = stored(spark, strong.join(words, "pattern").select("kind", "pattern", "occurs"), "patterns")
    values = stored(spark, edges.groupBy("kind", "value").agg(F.max("seed").cast("double").alias("score")), "values")
    for _ in range(rounds):
        joined = edges.join(values, ["kind", "value"])
        scored = joined.groupBy("kind", "pattern").agg(F.sum(F.col("score") * F.col("times")).alias("mass"))
        scored = scored.join(patterns, ["kind", "pattern"]).select(
            "kind", "pattern", F.least(F.lit(0.99), F.col("mass") / F.col("occurs")).alias("trust")
        )
        scored = stored(spark, scored, "trust")
        doubt = F.sum(F.ln(1 - F.coalesce("trust", F.lit(0.0))))
        values = edges.join(scored, ["kind", "pattern"], "left").groupBy("kind", "value").agg(
            F.when(F.max("seed") == 1, 1.0).otherwise(1 - F.exp(doubt)).alias("score")
        )
        values = stored(spark, values, "values")
    good = values.filter(F.col("score") >= score).select("kind", "value")
    return mentions.filter("NOT seed").join(good, ["kind", "value"], "left_semi")


def find_pii(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    Counts and base_sha256 are those of the base rules; spans adds what the patterns
    discovered, by kind and start. Null and empty texts have no spans; repeated rows and ids are
    handled row by row; other columns are ignored. Texts are never shuffled.
    """
    text = whole_text()
    rows = docs.select("doc_id", text.alias("text")).select(
        "doc_id", "text", *[base_spans(F.col("text"), k).alias(k) for k in KINDS]
    )
    base = {k: F.col(k) for k in KINDS}
    rows = rows.select(
        F.monotonically_increasing_id().alias("row"),
        "doc_id",
        *[F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias(k) for k in KINDS],
        F.concat(*[_mentions(F.col("text"), k, base) for k in KINDS]).alias("mentions"),
    )
    rows = stored(spark, rows, "spans")
    mentions = rows.select("row", F.explode("mentions").alias("m")).select("row", "m.*")
    new = discovered(spark, docs, mentions)
    more = new.groupBy("row").agg(F.collect_set(F.struct("kind", "start", "end")).alias("more"))
    rows = rows.join(more, "row", "left")
    extra = F.coalesce("more", F.array().cast("array<struct<kind:string,start:int,end:int>>"))

    def labelled(kind: str) -> Column:
        return F.transform(kind, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))

    def all_of(kind: str) -> Column:
        spans = F.concat(labelled(kind), F.filter(extra, lambda s: s["kind"] == kind))
        return F.array_sort(spans, lambda a, b: a["start"] - b["start"])

    return rows.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(_joined(F.concat(*map(labelled, KINDS))).cast("binary"), 256).alias("base_sha256"),
        _joined(F.concat(*map(all_of, KINDS))).alias("spans"),
        F.coalesce(F.size("more"), F.lit(0)).cast("long").alias("n_discovered"),
    )
