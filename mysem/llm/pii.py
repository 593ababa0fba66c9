"""Personal data in texts: fixed formats, and bootstrapped contextual extraction beyond them.

The fixed formats find seeds. The words next to trusted instances, at first the seeds, are lexical patterns; what has a fitting
shape next to the same words is a candidate instance. Patterns and instances form a graph that is scored in turns: a pattern by the
trusted instances beside its word per occurrence of the word in all texts, an instance by the patterns it stands
beside. An instance of high score is reported, and vouches for patterns in the next turn, until no instance is added. Everything is DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mysem.llm import texts as T
from mysem.session import written

# The kinds in order.
KINDS = ("email", "ip", "card", "phone")

# The fixed formats. A match may only begin where no character of its first class stands before, or where the last match
# ended: elsewhere an earlier begin would have matched too, and long runs stay linear. Possessive where nothing can be given back.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?+[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
_OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"

# What may be a candidate, anywhere in a text, and the shapes that make it one of a kind. Each alternative begins only where none of its characters
# stands before, or gives nothing back, so long runs stay linear.
CANDIDATE = (
    r"(?<![^\s@<>\"',;()])[^\s@<>\"',;()]++@[^\s@<>\"',;()]++|(?<![0-9A-Za-z:])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}"
    r"|(?<![0-9.])[0-9]++(?:\.[0-9]++){3}(?![0-9.])|(?<![0-9])\(?[0-9](?:[\x20()./-]{0,2}+[0-9]){6,}+"
)
SHAPES = {
    "email": r"^[^@\s]+@[^@\s]+$",
    "ip": r"^(?:[0-9]+(?:\.[0-9]+){3}|(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4})$",
    "card": r"^[0-9]{4,}(?:[\x20-]?[0-9]{4,}){2,4}$",
    "phone": r"^(?=(?:[^0-9]*[0-9]){7,15}[^0-9]*$)\(?[0-9][0-9()./\x20-]+$",
}

# Different trusted instances a pattern needs; what a pattern and an instance need to be trusted.
MIN_SUPPORT = 5
TRUSTED_PATTERN = 0.5
TRUSTED_INSTANCE = 0.8
# Scoring ends when no instance's trust grows by more.
SETTLED = 0.01
# Up to so many words of patterns are looked up in a list while the texts are read.
LISTED_WORDS = 10_000

OTHERS = len(KINDS)
_HIT = "array<struct<kind:int,place:int,gap:int,value:string,left:string,right:string>>"


def _word(gap: Column, last: bool) -> Column:
    """The last (or first) run of letters of a gap in small letters, or nothing."""
    return F.lower(F.regexp_extract(gap, r"(?<!\p{L})(\p{L}++)\P{L}*+$" if last else r"^\P{L}*+(\p{L}++)", 1))


def hits(df: DataFrame, text: str, pattern: str, kind: int, out: str, only: Column) -> DataFrame:
    """Add the matches of ``pattern``, leftmost and not overlapping, in their order, with the characters since the last one and the words around."""
    df = df.withColumn("__hits", F.regexp_extract_all(F.when(only, F.col(text)).otherwise(""), F.lit(pattern), F.lit(0)))
    df = df.withColumn("__gaps", F.when(F.size("__hits") > 0, F.split(F.col(text), pattern, -1)))
    n = F.size("__hits")
    df = df.withColumns({"__before": F.slice("__gaps", F.lit(1), n), "__after": F.slice("__gaps", F.lit(2), n)})

    def one(x: Column, i: Column) -> Column:
        gap, value, after = x["__before"], x["__hits"], x["__after"]
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("place"), F.length(gap).alias("gap"), value.alias("value"), _word(gap, True).alias("left"), _word(after, False).alias("right")
        )

    found = F.when(n > 0, F.transform(F.arrays_zip("__before", "__hits", "__after"), one)).otherwise(F.array().cast(_HIT))
    return df.withColumn(out, found.cast(_HIT)).drop("__hits", "__gaps", "__before", "__after")


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return value.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(value)
        return F.length(digits).between(12, 19) & F.call_function("luhn_check", digits)
    if kind == "phone":
        return F.length(_digits(value)).between(9, 15)
    return F.lit(True)


def spans(found: DataFrame) -> DataFrame:
    """``row, kind, start, end, value, left, right, base`` of the fixed formats, and of the candidates that overlap none, of rows of ``row, hits``.

    A match's place is the sum of what stands before it, over thin rows; so a text may have any number of matches.
    """
    flat = found.select("row", F.explode("hits").alias("h")).select("row", "h.*")
    before = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    flat = flat.withColumn("end", F.sum(F.col("gap") + F.length("value")).over(before)).withColumn("start", F.col("end") - F.length("value"))
    value = F.col("value")
    valid = F.lit(True)
    for kind, name in enumerate(KINDS):
        valid = F.when(F.col("kind") == kind, _valid(name, value)).otherwise(valid)
    base = flat.where(F.col("kind") < OTHERS).where(valid).withColumn("base", F.lit(True))
    # Punctuation around a candidate is not part of it.
    others = flat.where(F.col("kind") == OTHERS).withColumn("tail", F.regexp_replace("value", r"^[^A-Za-z0-9(:]+", ""))
    others = others.withColumn("start", F.col("end") - F.length("tail")).withColumn("value", F.regexp_replace("tail", r"(?<![^A-Za-z0-9:])[^A-Za-z0-9:]++$|[^A-Za-z0-9:]$", ""))
    shape = F.coalesce(*[F.when(value.rlike(SHAPES[name]), F.lit(i)) for i, name in enumerate(KINDS)])
    others = others.withColumn("end", F.col("start") + F.length("value")).withColumn("kind", shape).where("kind IS NOT NULL").withColumn("base", F.lit(False))
    every = base.unionByName(others.drop("tail")).select("row", "kind", "start", "end", "value", "left", "right", "base")
    # Both windows grow from one end; Spark would sum a window up to the end anew for each row.
    earlier = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("row").orderBy(F.desc("start")).rowsBetween(Window.unboundedPreceding, -1)
    reached = F.max(F.when(F.col("base"), F.col("end"))).over(earlier)
    follows = F.min(F.when(F.col("base"), F.col("start"))).over(later)
    apart = every.withColumns({"reached": reached, "follows": follows})
    free = (F.coalesce("reached", F.col("start")) <= F.col("start")) & (F.coalesce("follows", F.col("end")) >= F.col("end"))
    return apart.where(F.col("base") | free).drop("reached", "follows")


def _edges(found: DataFrame) -> DataFrame:
    """Pattern (kind, side, word) and instance of every neighbourhood, counted; ``seed`` if a fixed format found the instance."""
    sides = F.explode(F.array(F.struct(F.lit("left").alias("side"), F.col("left").alias("word")), F.struct(F.lit("right").alias("side"), F.col("right").alias("word"))))
    flat = found.select("kind", F.lower("value").alias("instance"), "base", sides.alias("p")).select("kind", "instance", "base", "p.*").where("word <> ''")
    return flat.groupBy("kind", "side", "word", "instance").agg(F.count("*").alias("n"), F.bool_or("base").alias("seed"))


def _occurrences(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often the patterns' words occur in all texts."""
    words = texts.select(F.explode(F.split(F.lower("text"), r"\P{L}+")).alias("word"))
    wanted = patterns.select("word").distinct()
    if wanted.count() <= LISTED_WORDS:
        return words.where(F.col("word").isin([r.word for r in wanted.collect()])).groupBy("word").agg(F.count("*").alias("occurs"))
    return words.groupBy("word").agg(F.count("*").alias("occurs")).join(wanted, "word", "left_semi")


def trusted_instances(found: DataFrame, texts: DataFrame) -> DataFrame:
    """``kind, instance`` of the candidates that patterns vouch for.

    A pattern's score is the share of its word's occurrences that stand beside instances, each by its trust; few different ones are weak evidence.
    A candidate's trust is the chance that not all patterns beside it are wrong. Each turn goes over the graph alone, not the texts.
    """
    key, of = ["kind", "side", "word"], ["kind", "instance"]
    edges = written(_edges(found), "pii-edges")
    # A pattern with fewer neighbours can never be trusted, and one without candidates discovers nothing.
    able = edges.groupBy(*key).agg(F.count("*").alias("n"), F.count_if(~F.col("seed")).alias("new")).where((F.col("n") >= MIN_SUPPORT) & (F.col("new") > 0)).select(*key)
    able = written(able, "pii-patterns")
    counted = written(_occurrences(texts, able), "pii-words")
    known = written(edges.join(able, key, "left_semi").join(counted, "word"), "pii-graph")
    seeds = known.where("seed").select(*of, F.lit(1.0).alias("trust")).distinct()
    trust = written(seeds, "pii-trust")
    while True:
        beside = known.join(trust, of).groupBy(*key).agg(F.sum(F.col("n") * F.col("trust")).alias("n"), F.max("occurs").alias("occurs"), F.sum("trust").alias("support"))
        share = F.least(F.col("n") / F.col("occurs"), F.lit(1.0))
        pattern = beside.where(F.col("support") >= MIN_SUPPORT).select(*key, (share * F.col("support") / (F.col("support") + 1)).alias("score"))
        pattern = written(pattern.where(F.col("score") >= TRUSTED_PATTERN), "pii-pattern-scores")
        missed = F.sum(F.log(1 - F.least("score", F.lit(0.999))))
        scored = known.where("NOT seed").join(pattern, key).groupBy(*of).agg((1 - F.exp(missed)).alias("trust"))
        before, trust = trust, written(seeds.unionByName(scored.join(seeds, of, "left_anti")), "pii-trust")
        # Trust only grows from turn to turn.
        change = trust.join(before.withColumnRenamed("trust", "was"), of, "left").agg(F.max(F.col("trust") - F.coalesce("was", F.lit(0.0)))).first()[0]
        if change is None or change < SETTLED:
            return trust.where(F.col("trust") >= TRUSTED_INSTANCE).select(*of)


def _joined(found: Column) -> Column:
    """``kind:start:end`` of spans (start, kind, end), comma-joined in order."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(F.array_sort(found), lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id``, counts of the fixed formats, ``base_sha256``, ``spans`` and ``n_found`` (spans beyond the fixed formats).

    Spans are ``kind:start:end`` in code points, by start, then kind as listed. Null texts count as empty. Rows that repeat an id
    each get a row. A table without rows gives none.
    """
    # Thin rows are numbered once; texts are read again only for their words.
    rows = T.inputs(df, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    numbered = rows.withColumn("row", F.monotonically_increasing_id())
    text = F.col("text")
    has_digit = text.rlike("[0-9]")
    searched = [(EMAIL, text.contains("@")), (IP, has_digit), (CARD, has_digit), (PHONE, text.contains("+")), (CANDIDATE, has_digit | text.contains("@") | text.contains("::"))]
    for kind, (pattern, only) in enumerate(searched):
        numbered = hits(numbered, "text", pattern, kind, f"__h{kind}", only)
    raw = written(numbered.select("row", "doc_id", F.concat(*[F.col(f"__h{kind}") for kind in range(len(searched))]).alias("hits")), "pii-hits")
    found = written(spans(raw), "pii-spans")
    trusted = written(trusted_instances(found, rows), "pii-found")
    kept = found.where("base").unionByName(
        found.where("NOT base").withColumn("instance", F.lower("value")).join(trusted, ["kind", "instance"], "left_semi").select(*found.columns)
    )
    one = F.struct(F.col("start").cast("long").alias("start"), "kind", F.col("end").cast("long").alias("end"))
    per_row = kept.groupBy("row").agg(
        F.collect_list(F.when(F.col("base"), one)).alias("base"),
        F.collect_list(one).alias("every"),
        *[F.count_if(F.col("base") & (F.col("kind") == k)).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.count_if(~F.col("base")).alias("n_found"),
    )
    joined = raw.select("row", "doc_id").join(written(per_row, "pii-by-row"), "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return joined.select(
        "doc_id",
        *[zero(f"n_{name}") for name in KINDS],
        F.sha2(F.coalesce(_joined(F.col("base")), F.lit("")).cast("binary"), 256).alias("base_sha256"),
        F.coalesce(_joined(F.col("every")), F.lit("")).alias("spans"),
        zero("n_found"),
    )
