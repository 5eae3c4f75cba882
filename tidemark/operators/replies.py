"""Annotation replies: from envelope lines to items, to one annotation per document, to one row per mention.

Replies are parsed as VARIANT values, because the presence of a key matters apart from its value (an explicit null
hides later names of the same field) and values come in mixed types. Lines that are no JSON, failed replies and items
of the wrong shape are skipped, never fatal.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import coerce
from tidemark.functions.keys import symbol_key

TICKER = "array<struct<symbol: string, asset_type: string, sentiment_label: string, sentiment_score: double, conf: double>>"


@dataclass(frozen=True)
class Dialect:
    """How a version of the reply form is read: field names in the order of precedence, document keys, and defaults."""

    label: tuple[str, ...] = ("sentiment_label", "label", "sentiment")
    score: tuple[str, ...] = ("sentiment_score", "score")
    conf: tuple[str, ...] = ("conf", "confidence")
    posts: tuple[str, ...] = ("submission_id",)
    comments: tuple[str, ...] = ("comment_id",)
    status: tuple[str, ...] = ("response.body.status",)
    asset_types: bool = True
    unknown_forward: bool | None = None
    posts_exclude_comments: bool = True
    strict: bool = False


DIALECTS = {
    "v1": Dialect(label=("sentiment_label",), score=("sentiment_score",), conf=("confidence",), comments=("submission_id",), status=(), asset_types=False, posts_exclude_comments=False, strict=True),
    "v2": Dialect(label=("label", "sentiment_label"), score=("score", "sentiment_score"), comments=("submission_id",), status=("response.status", "response.body.status"), asset_types=False, unknown_forward=False, posts_exclude_comments=False),
    "v3": Dialect(posts=("submission_id", "id"), comments=("comment_id", "submission_id", "id"), asset_types=False, unknown_forward=False, posts_exclude_comments=False),
    "v4": Dialect(),
}


def at(v: Column, path: str) -> Column:
    """The variant at a path: null where the key is absent, a variant null where it holds null."""
    return F.try_variant_get(v, path, "variant")


def kind_of(v: Column) -> Column:
    return F.schema_of_variant(v)


def string_at(v: Column, path: str) -> Column:
    """A string at a path; null for every other type."""
    return F.when(kind_of(at(v, path)) == "STRING", F.try_variant_get(v, path, "string"))


def number_at(v: Column, *paths: str) -> Column:
    """The number under the first of several keys that is present: numbers, numbers in text, and booleans as 1 or 0."""
    found = F.coalesce(*(at(v, p) for p in paths))
    kind = kind_of(found)
    plain = F.when(kind == "BOOLEAN", F.try_variant_get(found, "$", "boolean").cast("double")).otherwise(F.trim(F.try_variant_get(found, "$", "string")).try_cast("double"))
    return F.when(kind.rlike("^(STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL)") & ~F.isnan(plain), plain)


def reply_text(line: Column, dialect: Dialect = DIALECTS["v4"]) -> Column:
    """The text of a reply line: from the body, else the short form, else the bare output; null if it did not complete."""
    v = F.try_parse_json(line)
    short = string_at(v, "$.response.output_text")
    found = F.coalesce(string_at(v, "$.response.body.output[0].content[0].text"), F.when(F.length(F.trim(short)) > 0, short), string_at(v, "$.response.output[0].content[0].text"))
    ended = F.lit(True)
    for path in dialect.status:
        status = string_at(v, f"$.{path}")
        ended = ended & (status.isNull() | status.isin("", "completed"))
    return F.when(ended, found)


def reply_items(text: Column) -> Column:
    """The items of a payload: the list under ``results``, the list itself, or a single object that names a document."""
    v = F.try_parse_json(text)
    single = at(v, "$.submission_id").isNotNull() | at(v, "$.comment_id").isNotNull()
    return (
        F.when(kind_of(at(v, "$.results")).startswith("ARRAY"), F.try_variant_get(v, "$.results", "array<variant>"))
        .when(kind_of(v).startswith("ARRAY"), F.try_variant_get(v, "$", "array<variant>"))
        .when(kind_of(v).startswith("OBJECT") & single, F.array(v))
    )


def ticker(t: Column, dialect: Dialect = DIALECTS["v4"]) -> Column:
    """A normalised mention of an item; null without a symbol."""
    name = string_at(t, "$.symbol") if dialect.strict else F.coalesce(F.nullif(string_at(t, "$.symbol"), F.lit("")), string_at(t, "$.ticker"))
    symbol = name if dialect.strict else symbol_key(name)
    label = F.coalesce(*(at(t, f"$.{k}") for k in dialect.label))
    text = F.try_variant_get(label, "$", "string")
    known = text if dialect.strict else F.when(kind_of(label) == "STRING", coerce.sentiment_label(text)).otherwise(text)
    return F.when(
        symbol.isNotNull(),
        F.struct(
            symbol.alias("symbol"),
            (coerce.asset_type(string_at(t, "$.asset_type")) if dialect.asset_types else F.lit(None).cast("string")).alias("asset_type"),
            known.alias("sentiment_label"),
            number_at(t, *(f"$.{k}" for k in dialect.score)).alias("sentiment_score"),
            number_at(t, *(f"$.{k}" for k in dialect.conf)).alias("conf"),
        ),
    )


def is_forward(v: Column, dialect: Dialect = DIALECTS["v4"]) -> Column:
    """true/false, also in the usual spellings as text; other text is the dialect's default, everything else null."""
    x = at(v, "$.is_forward")
    spelt = coerce.tri_state(F.try_variant_get(x, "$", "string"))
    return F.when(kind_of(x) == "BOOLEAN", F.try_variant_get(x, "$", "boolean")).when(kind_of(x) == "STRING", spelt if dialect.unknown_forward is None else F.coalesce(spelt, F.lit(dialect.unknown_forward)))


def tickers_of(it: Column) -> Column:
    return F.coalesce(F.try_variant_get(it, "$.tickers", "array<variant>"), F.array().cast("array<variant>"))


def well_formed(it: Column) -> Column:
    """Whether an item has every field that the strict form asks for, with values that fit."""
    full = lambda t: string_at(t, "$.symbol").isNotNull() & string_at(t, "$.sentiment_label").isNotNull() & number_at(t, "$.sentiment_score").isNotNull() & number_at(t, "$.confidence").isNotNull()
    return F.coalesce(string_at(it, "$.submission_id").isNotNull() & F.try_variant_get(it, "$.tickers", "array<variant>").isNotNull() & F.forall(tickers_of(it), full), F.lit(False))


def annotations(lines: DataFrame, kind: str, comment_items_too: bool = False, version: str = "v4") -> DataFrame:
    """(id, ticker_items, is_forward, value_score) per document from reply lines (file, line_no, line).

    ``kind`` 'rs' takes items by their post, 'rc' by their comment, under the keys of the version's dialect; in v4 items
    that also name a comment are none of the post, unless ``comment_items_too``. Of several items of a document the last
    in the order of (file, line, position) wins. In v1 one malformed item voids its whole reply.
    """
    dialect = DIALECTS[version]
    # a generator keeps a parsed value from being computed anew wherever it is used
    texts = lines.select("file", "line_no", F.explode(F.array(reply_text(F.col("line"), dialect))).alias("text")).where(F.length("text") > 0)
    whole = texts.select("file", "line_no", F.explode(F.array(reply_items(F.col("text")))).alias("items"))
    if dialect.strict:
        whole = whole.where(F.forall("items", well_formed))
    items = whole.select("file", "line_no", F.posexplode("items").alias("pos", "it"))
    named = [F.nullif(F.trim(F.try_variant_get("it", f"$.{k}", "string")), F.lit("")) for k in (dialect.posts if kind == "rs" else dialect.comments)]
    keyed = items.withColumn("id", F.coalesce(*named)).where("id IS NOT NULL")
    if kind == "rs" and dialect.posts_exclude_comments and not comment_items_too:
        keyed = keyed.where(F.try_variant_get("it", "$.comment_id", "string").isNull())
    mentions = F.filter(F.transform(tickers_of(F.col("it")), lambda t: ticker(t, dialect)), lambda t: t.isNotNull()).cast(TICKER)
    typed = keyed.select(
        "id",
        F.struct("file", "line_no", "pos").alias("place"),
        F.struct(mentions.alias("ticker_items"), is_forward(F.col("it"), dialect).alias("is_forward"), number_at(F.col("it"), "$.value_score").alias("value_score")).alias("a"),
    )
    return typed.groupBy("id").agg(F.max_by("a", "place").alias("a")).select("id", "a.*")


def annotate(clean: DataFrame, notes: DataFrame, kind: str) -> DataFrame:
    """Documents with their annotation; posts without one have no tickers, comments without one fall out."""
    joined = clean.join(notes, "id", "left" if kind == "rs" else "inner")
    items = F.coalesce("ticker_items", F.array().cast(TICKER))
    return joined.withColumn("ticker_items", items).withColumn("tickers", F.col("ticker_items.symbol")).withColumn("kind", F.lit("submission" if kind == "rs" else "comment"))


def counters() -> list[Column]:
    """What is counted while annotated documents are written: all of them, and those that name a ticker."""
    return [F.count(F.lit(1)).alias("docs"), F.count_if(F.size("tickers") > 0).alias("with_tickers")]


def without_reply(clean: DataFrame, notes: DataFrame) -> DataFrame:
    """The ids for which no reply came."""
    return clean.select("id").join(notes.select("id"), "id", "left_anti")


PASSED = ("created_utc", "subreddit", "score", "num_comments", "parent_id", "link_id", "permalink", "author", "__day__")


def explode_mentions(annotated: DataFrame) -> DataFrame:
    """One row per document and mentioned symbol, with the document's fields; symbols are not deduplicated."""
    passed = [c for c in PASSED if c in annotated.columns]
    flat = annotated.select("id", "kind", "is_forward", "value_score", *passed, F.explode("ticker_items").alias("t")).where(F.length("t.symbol") > 0)
    return flat.select("id", "kind", "t.symbol", "t.asset_type", "t.sentiment_label", "t.sentiment_score", "t.conf", "is_forward", "value_score", *passed)


def apply_aliases(df: DataFrame, symbol: str, aliases: DataFrame) -> DataFrame:
    """Symbols replaced by an alias table (raw, normalized); symbols without an alias stay."""
    table = aliases.select(F.upper(F.trim("raw")).alias("__raw"), F.upper(F.trim("normalized")).alias("__norm")).where("__raw <> '' AND __norm <> ''")
    return df.join(table, F.upper(F.trim(F.col(symbol))) == F.col("__raw"), "left").withColumn(symbol, F.coalesce("__norm", F.col(symbol))).drop("__raw", "__norm")
