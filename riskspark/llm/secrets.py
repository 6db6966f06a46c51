"""Secret scans with multipart credential linking, in DataFrame functions only.

Base kinds, each leftmost and non-overlapping on its own:
* assign: a credential word, ``:`` or ``=`` and a value of 8 or more characters;
* access: ``AKIA`` and capitals or digits, 16 or more characters together;
* hex: 32 or more lower-case hexadecimal digits.
Weak kinds are parts that mean little alone:
* login: a user or key-id word, ``:`` or ``=`` and a value of 4 or more characters;
* bare: a run of 20 or more base64 characters that holds a letter and a digit and is in no base span;
* endpoint: an http, https, ftp, s3 or database address.
Within a scope of ``scope`` code points between starts, an interval join of the parts reports a bare
secret or login only beside a part of the other sort (secret: assign, hex, bare; identifier: access,
login), and an endpoint only beside both sorts. The join is a range window over a document's parts;
parts do not overlap within a kind, so a frame holds few of them and no pairs are formed.

Offsets are code points, end exclusive. A text is split at a pattern, and lengths of pieces and matches
are summed in a window, linear in the matches. Null texts are empty. Rows of equal id and text share
their spans. Empty tables give empty results. Values are not part of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Patterns of the base kinds and the values' least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{32,}"  # the same as runs of hex digits, dropped below 32
# Patterns of the weak kinds.
LOGIN = r"""(?i)(user_?name|user_?id|login|account|access_?key_?id|client_?id)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.@-]{4,}"""
BARE = r"[A-Za-z0-9+/_-]{20,}"
ENDPOINT = r"(?:https?|ftp|s3|postgres|postgresql|mysql|mongodb|redis|amqp)://[^\x00-\x20\x22\x27<>]+"
KINDS = ("assign", "access", "hex", "login", "bare", "endpoint")
BASE = KINDS[:3]


def matches(text: Column, kind: str, pattern: str, value: Column | None = None) -> Column:
    """Array of (kind, nth, gap before in code points, length, value); texts without a match cost one scan."""
    gaps = F.split(text, F.lit(pattern), -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if kind == "assign" else found
    numbered = F.transform(found, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), F.char_length(F.get(gaps, i)).alias("gap"), F.char_length(x).alias("size"),
        F.get(values, i).alias("value")))
    return F.when(F.rlike(text, F.lit(pattern)), numbered)


def parts(docs: DataFrame) -> DataFrame:
    """k1, k2, kind, start, end of the base spans and of all weak candidates of distinct documents."""
    text = F.col("__text")
    base = [matches(text, "assign", ASSIGN), matches(text, "access", ACCESS), matches(text, "hex", HEX)]
    named = F.rlike(text, F.lit(LOGIN)) | F.rlike(text, F.lit(ACCESS))
    weak = [
        matches(text, "login", LOGIN),
        F.when(named, matches(text, "bare", BARE)),  # a bare secret needs an identifier in its document
        F.when(named, matches(text, "endpoint", ENDPOINT)),
    ]
    empty = F.array().cast("array<struct<kind:string,nth:int,gap:int,size:int,value:string>>")
    found = docs.select("k1", "k2", F.explode(F.concat(*[F.coalesce(m, empty) for m in (*base, *weak)])).alias("m")).select("k1", "k2", "m.*").distinct()
    order = Window.partitionBy("k1", "k2", "kind").orderBy("nth")
    end = F.sum(F.col("gap") + F.col("size")).over(order)
    placed = found.repartition("k1", "k2").withColumn("end", end).withColumn("start", F.col("end") - F.col("size"))
    long_enough = (
        F.when(F.col("kind") == "assign", F.char_length("value") >= 8)
        .when(F.col("kind") == "access", F.char_length("value") >= 16)
        .when(F.col("kind") == "bare", F.rlike("value", F.lit("[0-9]")) & F.rlike("value", F.lit("[A-Za-z]")))
        .otherwise(True)
    )
    return placed.where(long_enough).select("k1", "k2", "kind", "start", "end")


def linked(found: DataFrame, scope: int) -> DataFrame:
    """The base spans, and the weak candidates that have their complements in scope."""
    doc = Window.partitionBy("k1", "k2")
    kind = F.col("kind")
    before = doc.orderBy("start", "end", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = doc.orderBy(F.desc("start"), F.desc("end"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)
    # a bare run that meets a base or login span is that span's value
    other = kind.isin(*BASE, "login")
    inside = (F.coalesce(F.max(F.when(other, F.col("end"))).over(before), F.lit(-1)) > F.col("start")) | (
        F.coalesce(F.min(F.when(other, F.col("start"))).over(after), F.lit(1 << 60)) < F.col("end"))
    free = found.withColumn("inside", inside).where((kind != "bare") | ~F.col("inside")).drop("inside")
    near = doc.orderBy("start").rangeBetween(-scope, scope)
    identifier = F.max(kind.isin("access", "login").cast("int")).over(near) == 1
    secret = F.max(kind.isin("assign", "hex", "bare").cast("int")).over(near) == 1
    keep = (
        F.when(kind == "login", F.col("secret")).when(kind == "bare", F.col("identifier"))
        .when(kind == "endpoint", F.col("secret") & F.col("identifier")).otherwise(True)
    )
    return free.withColumns({"identifier": identifier, "secret": secret}).where(keep).select("k1", "k2", "kind", "start", "end")


def joined_spans(spans: Column) -> Column:
    """kind:start:end by start, then kind as listed."""
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("rank"), s["end"], s["kind"])))
    return F.array_join(F.transform(ranked, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = 200) -> DataFrame:
    """id_col and the list of found parts (kind, start, end), one row per document."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col), text.alias("__text"), F.xxhash64(id_col).alias("k1"), F.xxhash64(text, F.octet_length(text)).alias("k2"))
    spans = linked(parts(keyed.select("k1", "k2", "__text")), scope).groupBy("k1", "k2").agg(F.collect_list(F.struct("kind", "start", "end")).alias("parts"))
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint>>")
    return keyed.drop("__text").join(spans, ["k1", "k2"], "left").select(id_col, F.coalesce("parts", none).alias("parts"))


def redacted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with the base kinds replaced by a mark."""
    text = F.col(text_col)
    short = r"""(?i)((?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)[A-Za-z0-9+/_.=-]{8,}"""
    text = F.regexp_replace(text, F.lit(short), F.lit(f"$1{mark}"))
    for pattern in (r"AKIA[A-Z0-9]{12,}", HEX):
        text = F.regexp_replace(text, F.lit(pattern), F.lit(mark))
    return docs.withColumn(text_col, text)
