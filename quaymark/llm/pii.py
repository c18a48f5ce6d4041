"""Operator 6 — personal data and information-theoretic sanitisation, in DataFrame operations only.

Base spans are regular-expression matches: a replacement puts a mark around every match, the text
is split at the marks, and lengths of the pieces give positions in code points.

The method: words near a protected value (within ``WINDOW`` code points) are its context.  With
probabilities as shares of all documents, the pointwise mutual information of a value e and a term
t, log(p(e,t) / (p(e) p(t))), says how much t reveals of e, and the information content -log p(e)
is all there is to reveal.  A term that reveals at least ``THRESHOLD`` of it, and does so in at least
``SUPPORT`` documents, exceeds the disclosure threshold: its occurrences near e are spans of kind
``term``.  Sanitising generalises base values to their kind and capitalised terms to ``[NAME]``, and
removes other terms.

Patterns use possessive quantifiers and start only where a run starts: the same matches, without
the stack and the retries that long runs would cost.

Defined cases: null text counts as empty and stays null when sanitised; no values gives zero counts
and empty strings; repeated rows get equal spans; null doc_id is kept; extra columns pass through
``sanitise`` and are ignored by the digest; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import count_rows, doc_columns, prepare, release, stage

KINDS = ("email", "ip", "card", "phone")
#: What a match of each kind looks like.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that must hold before a pattern is tried.
HINTS = {"email": "contains(body, '@')", "ip": "has_digit", "card": "has_digit", "phone": "contains(body, '+')"}
TERM = r"\p{L}[\p{L}\p{N}]{2,}+"
WINDOW, SUPPORT, THRESHOLD = 100, 2, 0.9
#: Terms, and bytes of spans, up to which they are broadcast; beyond, the join is shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 100_000, 32 << 20
SPAN = "struct<start:bigint,rank:int,stop:bigint,kind:string,value:string>"
MARK, OTHER = "\x01", "\x02"


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _pieces(column: str, pattern: str) -> str:
    """The text cut before and after every match: matches are the pieces at odd places."""
    return f"split(regexp_replace({column}, {_sql(pattern)}, '{MARK}$0{MARK}'), '{MARK}')"


def _matches(pieces: str, lengths: str, sums: str) -> str:
    """(start, value) of the matches; positions are sums over blocks of 256 pieces and the rest of a block."""
    add = "0L, (a, x) -> a + x"
    at = f"aggregate(slice({sums}, 1, i div 256), {add}) + aggregate(slice({lengths}, (i div 256) * 256 + 1, i % 256), {add})"
    body = f"transform(sequence(1, size({pieces}) - 2, 2), i -> named_struct('start', {at}, 'value', {pieces}[i]))"
    return f"if(size({pieces}) >= 3, {body}, cast(array() as array<struct<start:bigint,value:string>>))"


def _located(df: DataFrame, name: str, column: str, pattern: str, hint: str = "true") -> DataFrame:
    """A column ``name`` with (start, value) of all matches of a pattern."""
    p, n, s = f"{name}_p", f"{name}_n", f"{name}_s"
    df = df.withColumn(p, F.expr(f"if({hint}, {_pieces(column, pattern)}, array(''))"))
    df = df.withColumn(n, F.expr(f"transform({p}, x -> cast(length(x) as bigint))"))
    df = df.withColumn(s, F.expr(f"transform(sequence(0, (size({p}) - 1) div 256), b -> aggregate(slice({n}, b * 256 + 1, 256), 0L, (a, x) -> a + x))"))
    return df.withColumn(name, F.expr(_matches(p, n, s))).drop(p, n, s)


def _valid(kind: str) -> str:
    """The test that a match m has to pass."""
    if kind == "email":
        return "true"
    if kind == "ip":
        part = r"regexp_replace(x, '^0+(?=[0-9])', '')"
        return f"forall(split(m.value, '[.]'), x -> length({part}) <= 3 and coalesce(try_cast({part} as int), 256) <= 255)"
    digits = "regexp_replace(m.value, '[^0-9]', '')"
    if kind == "phone":
        return f"length({digits}) between 10 and 15"
    twice = "aggregate(transform(sequence(1, length({d})), i -> cast(substring({d}, length({d}) - i + 1, 1) as int) * if(i % 2 = 0, 2, 1)), 0, (a, x) -> a + if(x > 9, x - 9, x))"
    return f"length({digits}) between 14 and 19 and ({twice.format(d=digits)}) % 10 = 0"


def base_spans(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with base: all base spans by start, then kind."""
    df = df.withColumn("body", F.translate(F.coalesce(F.col(text), F.lit("")), MARK, OTHER)).withColumn("has_digit", F.col("body").rlike("[0-9]"))
    for rank, kind in enumerate(KINDS):
        df = _located(df, f"m_{kind}", "body", PATTERNS[kind], HINTS[kind])
        span = f"named_struct('start', m.start, 'rank', {rank}, 'stop', m.start + length(m.value), 'kind', '{kind}', 'value', m.value)"
        df = df.withColumn(f"m_{kind}", F.expr(f"transform(filter(m_{kind}, m -> {_valid(kind)}), m -> {span})"))
    found = [f"m_{k}" for k in KINDS]
    return df.withColumn("base", F.array_sort(F.concat(*found))).drop(*found, "has_digit")


def key(text: str = "text") -> Column:
    """Rows with equal doc_id and text have equal spans and one key."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col(text), F.lit("")))


def scan(documents: DataFrame) -> DataFrame:
    """key, doc_id, base spans and the context of each of them, of every document."""
    df = base_spans(doc_columns(documents, "doc_id", "text").withColumn("key", key()))
    context = f"""transform(base, s -> named_struct('kind', s.kind, 'value', s.value, 'start', s.start, 'stop', s.stop,
        'before', substring(body, cast(greatest(s.start - {WINDOW}, 0) as int) + 1, cast(least(s.start, {WINDOW}L) as int)), 'cut_before', s.start > {WINDOW},
        'after', substring(body, cast(s.stop as int) + 1, {WINDOW}), 'cut_after', length(body) > s.stop + {WINDOW}))"""
    return df.select("key", "doc_id", "base", F.expr(context).alias("contexts"))


def context_terms(scanned: DataFrame) -> DataFrame:
    """key, entity, term, start and stop of every whole word near a protected value."""
    rows = scanned.where(F.size("contexts") > 0).select("key", F.explode("contexts").alias("c")).select("key", "c.*")
    rows = _located(_located(rows, "left", "before", TERM), "right", "after", TERM)
    kept_left = "filter(left, m -> not (cut_before and m.start = 0))"
    kept_right = f"filter(right, m -> not (cut_after and m.start + length(m.value) = {WINDOW}))"
    moved_left = f"transform({kept_left}, m -> named_struct('start', m.start + greatest(start - {WINDOW}, 0L), 'value', m.value))"
    moved_right = f"transform({kept_right}, m -> named_struct('start', m.start + stop, 'value', m.value))"
    rows = rows.select("key", F.concat_ws(":", "kind", "value").alias("entity"), F.explode(F.expr(f"concat({moved_left}, {moved_right})")).alias("m"))
    return rows.select("key", "entity", F.lower("m.value").alias("term"), "m.start", (F.col("m.start") + F.length("m.value")).alias("stop"), "m.value")


def document_frequency(documents: DataFrame, terms: DataFrame) -> DataFrame:
    """term and df: in how many of all documents each of the terms occurs."""
    words = documents.select(F.explode(F.array_distinct(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}\p{N}]+"))).alias("term"))
    if count_rows(terms, BROADCAST_ROWS) <= BROADCAST_ROWS:
        return words.join(F.broadcast(terms), "term", "left_semi").groupBy("term").agg(F.count("*").alias("df"))
    return words.groupBy("term").agg(F.count("*").alias("df")).join(terms, "term", "left_semi")


def disclosing(spark: SparkSession, documents: DataFrame, scanned: DataFrame, near: DataFrame) -> DataFrame:
    """entity and term of all pairs that exceed the disclosure threshold."""
    pairs = near.select("key", "entity", "term").distinct().groupBy("entity", "term").agg(F.count("*").alias("both")).where(F.col("both") >= SUPPORT)
    pairs = stage(spark, pairs, "pairs")
    entities = near.select("key", "entity").distinct().groupBy("entity").agg(F.count("*").alias("entities"))
    frequency = document_frequency(documents, pairs.select("term").distinct())
    total = scanned.count()
    log = F.log2(F.col("both").cast("double") * F.lit(float(max(1, total))) / (F.col("entities") * F.col("df")))
    known = F.log2(F.lit(float(max(1, total))) / F.col("entities"))
    scored = pairs.join(entities, "entity").join(frequency, "term").withColumn("pmi", log).withColumn("content", known)
    return scored.where((F.col("content") > 0) & (F.col("pmi") >= THRESHOLD * F.col("content"))).select("entity", "term")


def staged_spans(spark: SparkSession, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What ``scan`` and ``term_spans`` give, written."""
    scanned = stage(spark, scan(documents), "scanned")
    near = stage(spark, context_terms(scanned), "near")
    terms = stage(spark, term_spans(documents, scanned, near), "terms")
    release(spark, near)
    return scanned, terms


def term_spans(documents: DataFrame, scanned: DataFrame, near: DataFrame) -> DataFrame:
    """key and terms: the spans of disclosing terms of the documents that have some."""
    spark = documents.sparkSession
    marked = near.join(disclosing(spark, documents, scanned, near), ["entity", "term"])
    span = F.struct("start", F.lit(len(KINDS)).alias("rank"), "stop", F.lit("term").alias("kind"), "value")
    return marked.groupBy("key").agg(F.array_sort(F.collect_set(span)).alias("terms"))


def _few(rows: DataFrame, column: str) -> bool:
    """Whether ``rows`` with their spans are small enough to be broadcast: a span is its values and some numbers."""
    size = F.aggregate(column, F.lit(64).cast("long"), lambda a, s: a + 64 + 4 * (s["stop"] - s["start"]))
    return (rows.agg(F.sum(size)).first()[0] or 0) <= BROADCAST_BYTES


def _with_terms(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` (key, base, ...) with spans: base and those terms that touch no base span."""
    joined = rows.join(F.broadcast(terms) if _few(terms, "terms") else terms, "key", "left")
    none = F.expr(f"cast(array() as array<{SPAN}>)")
    clear = F.expr("filter(terms, t -> not exists(base, b -> t.start < b.stop and b.start < t.stop))")
    return joined.withColumn("spans", F.when(F.col("terms").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", F.coalesce(clear, none))))).drop("terms")


def _joined(column: str) -> Column:
    return F.expr(f"array_join(transform({column}, s -> concat(s.kind, ':', s.start, ':', s.stop)), ',')")


def pii_digest(documents: DataFrame) -> DataFrame:
    """doc_id, counts by kind, base_sha256 and all spans of every document."""
    spark = prepare(documents.sparkSession)
    scanned, terms = staged_spans(spark, documents)
    rows = _with_terms(scanned.select("key", "doc_id", "base"), terms)
    counts = [F.expr(f"cast(size(filter(base, s -> s.kind = '{k}')) as bigint)").alias(f"n_{k}") for k in KINDS]
    return rows.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def sanitise(documents: DataFrame) -> DataFrame:
    """The documents with protected values generalised and disclosing terms generalised or removed."""
    spark = prepare(documents.sparkSession)
    scanned, terms = staged_spans(spark, documents)
    changed = _with_terms(scanned.where(F.size("base") > 0).select("key", "base").dropDuplicates(["key"]), terms).select(F.col("key").alias("__key"), F.col("spans").alias("__spans"))
    changed = stage(spark, changed, "spans")
    joined = documents.withColumn("__key", key()).join(F.broadcast(changed) if _few(changed, "__spans") else changed, "__key", "left")
    label = "case when s.kind <> 'term' then concat('[', upper(s.kind), ']') when s.value rlike '^\\\\p{Lu}' then '[NAME]' else '' end"
    # Overlapping spans become one: what an earlier span has covered is not written again.
    step = f"""(a, s) -> named_struct('at', greatest(a.at, s.stop), 'parts',
        if(s.start >= a.at, concat(a.parts, array(substring(text, cast(a.at as int) + 1, cast(s.start - a.at as int)), {label})), a.parts))"""
    finish = "a -> concat(array_join(a.parts, ''), substring(text, cast(a.at as int) + 1))"
    rebuilt = F.expr(f"aggregate(__spans, named_struct('at', 0L, 'parts', cast(array() as array<string>)), {step}, {finish})")
    out = joined.withColumn("text", F.when(F.col("__spans").isNull(), F.col("text")).otherwise(rebuilt))
    return out.select(*[F.col(f"`{c}`") for c in documents.columns])
