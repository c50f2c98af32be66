"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans are the matches of three patterns that are long enough (``assign``, ``access``, ``hex``).
Weaker candidates say little alone: short or split identifiers, short or unusually named secrets,
and endpoints. They are parts of a credential, and are linked by an interval join within a scope of
``SCOPE`` code points: an identifier is reported only near a secret, a secret only near an
identifier or an endpoint, an endpoint only near both. Base spans count as parts as well: access
keys as identifiers, assignments and hex runs as secrets. Names of parts may follow other words
joined by ``_`` or ``-`` (DB_USER, aws_secret_access_key) and end in words such as _id, _key.

Plan: one regular expression finds the few texts with any candidate. Match positions are running
sums of the lengths of matches and of what lies between them. Parts are narrow rows
(id, text hash, kind, start, end); the join key is (id, text hash, slice of the text), its result is
a semi-join, so no pairs are made and a slice holds at most as many parts as it has characters.

Null texts are empty. Null ids, repeated rows, ties and further columns are handled: rows are told
apart by id and text, and equal rows have equal results. An empty table gives no rows. The distance
of two parts is that of their nearest ends.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SCOPE = 200

#: kind -> (pattern, group whose length counts, least length, kind below that length)
_QUOTED = r"""["']?\x20*[:=]\x20*["']?"""
PATTERNS: dict[str, tuple[str, int, int, str | None]] = {
    "assign": (rf"(?i)(password|passwd|secret|token|api_?key){_QUOTED}([A-Za-z0-9+/_.=-]+)", 2, 6, "short_assign"),
    "access": (r"AKIA[A-Z0-9]+", 0, 20, "short_access"),
    "hex": (r"[0-9a-f]{16,}", 0, 24, "short_hex"),
    "login": (rf"(?i)(?<![a-z0-9])((?:user|login|account|client|(?:access[_-]?)?key)[_-]?(?:id|name)|user|login|account)"
              rf"{_QUOTED}([A-Za-z0-9_.@+-]+)", 2, 3, None),
    "phrase": (rf"(?i)(?<![a-z0-9])(?<!api_)((?:(?:secret|access|account|private|shared|auth)[_-]?){{0,3}}key"
               r"|(?:secret|token|password|passwd)[_-](?:id|value|hash|string|code|phrase)"
               r"|(?:pwd|pass|passphrase|credential|auth)(?:[_-](?:value|hash|string|code|phrase|word))?)"
               rf"{_QUOTED}([A-Za-z0-9+/_.=@!#$%^&*-]+)", 2, 4, None),
    "endpoint": (r"""(?i)(?<![a-z0-9])[a-z][a-z0-9+.-]{1,20}://[^\s"'<>]+""", 0, 8, None),
}
BASE = ["assign", "access", "hex"]
#: The part of a credential that each kind stands for.
ROLES = {
    "assign": "secret", "access": "identifier", "hex": "secret", "short_assign": "secret", "short_access": "identifier",
    "short_hex": "secret", "login": "identifier", "phrase": "secret", "endpoint": "endpoint",
}
ORDER = list(ROLES)
#: A short hex run is a candidate only with both letters and digits: a number is none.
_MIXED = r"(?=.*[0-9])(?=.*[a-f])"
_ANY = "|".join(f"(?:{p})" for p in (
    r"(?i)(?:password|passwd|secret|token|api_?key|user|login|account|client[_-]?(?:id|name)|access_?key|pwd|pass|credential|auth|key)"
    rf"[a-z_-]{{0,12}}{_QUOTED}[^\s]",
    r"AKIA", r"[0-9a-f]{16}", r"://"))


def _pick(options: dict[str, str], kind: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in options.items() for x in pair])[kind]


def parts(rows: DataFrame) -> DataFrame:
    """id, row, kind, start, end of every candidate in ``rows`` (id, row, text)."""
    def found(kind: str) -> Column:
        pattern, group, _, _ = PATTERNS[kind]
        hits = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
        values = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
        return F.struct(
            F.lit(kind).alias("kind"), F.transform(F.split("text", pattern, -1), F.length).alias("gaps"), hits.alias("hits"),
            F.transform(values, F.length).alias("sizes"))

    some = rows.filter(F.col("text").rlike(_ANY))
    by_kind = some.select("id", "row", F.explode(F.array(*map(found, PATTERNS))).alias("f")).select("id", "row", "f.*")
    each = (by_kind.filter(F.size("hits") > 0)
            .select("id", "row", "kind", F.posexplode(F.arrays_zip("hits", "sizes", "gaps")).alias("at", "m"))
            .filter("m.hits is not null")  # one gap more than hits
            .select("id", "row", "kind", "at", F.length("m.hits").alias("length"), "m.sizes", "m.gaps",
                    F.when(F.col("kind") == "hex", F.col("m.hits").rlike(_MIXED)).alias("mixed"))
            .dropDuplicates(["id", "row", "kind", "at"]))
    running = Window.partitionBy("id", "row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    placed = each.withColumn("end", F.sum(F.col("gaps") + F.col("length")).over(running))
    least = F.create_map(*[F.lit(x) for kind, p in PATTERNS.items() for x in (kind, p[2])])[F.col("kind")]
    below = _pick({kind: p[3] for kind, p in PATTERNS.items() if p[3]}, F.col("kind"))
    named = F.when(F.col("sizes") >= least, F.col("kind")).otherwise(below)
    return (placed.withColumn("kind", named).filter("kind is not null")
            .filter((F.col("kind") != "short_hex") | F.col("mixed")).filter((F.col("kind") != "short_access") | (F.col("length") >= 8))
            .select("id", "row", "kind", (F.col("end") - F.col("length")).alias("start"), "end"))


def _near(weak: DataFrame, others: DataFrame, scope: int) -> DataFrame:
    """The rows of ``weak`` with a row of ``others`` in the same text at most ``scope`` away."""
    slices = others.select("id", "row", F.col("start").alias("o_start"), F.col("end").alias("o_end"), F.explode(
        F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("end") / scope))).alias("slice"))
    reach = weak.withColumn("slice", F.explode(F.sequence(
        F.floor(F.col("start") / scope) - 1, F.floor(F.col("end") / scope) + 1)))
    gap = F.greatest(F.col("b.o_start") - F.col("a.end"), F.col("a.start") - F.col("b.o_end"))
    return (reach.alias("a").join(slices.alias("b"), (F.col("a.id").eqNullSafe(F.col("b.id"))) & (F.col("a.row") == F.col("b.row"))
                                  & (F.col("a.slice") == F.col("b.slice")) & (gap <= scope), "left_semi")
            .drop("slice").distinct())


def linked(found: DataFrame, scope: int = SCOPE) -> DataFrame:
    """The weak candidates of ``found`` whose complementary parts lie within the scope."""
    role = _pick(ROLES, F.col("kind"))
    weak = found.filter(~F.col("kind").isin(BASE))

    def of(df: DataFrame, name: str) -> DataFrame:
        return df.filter(role == name)

    identifiers = _near(of(weak, "identifier"), of(found, "secret"), scope)
    secrets = _near(of(weak, "secret"), found.filter(role.isin("identifier", "endpoint")), scope)
    endpoints = _near(_near(of(weak, "endpoint"), of(found, "identifier"), scope), of(found, "secret"), scope)
    return identifiers.union(secrets).union(endpoints)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("id"), F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "row", F.xxhash64("text"))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """id, row (text hash), kind, start, end of every reported span, each once."""
    found = parts(_keyed(docs))
    return found.filter(F.col("kind").isin(BASE)).union(linked(found, scope))


def report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row of ``docs``."""
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(ORDER) for x in (k, i)])[F.col("kind")]
    per_row = scan(docs, scope).groupBy("id", "row").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in BASE],
        F.array_sort(F.collect_list(F.struct("start", rank.alias("rank"), "kind", "end"))).alias("all"))

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("all", lambda s: s["rank"] < len(BASE))
    per_row = per_row.select(F.col("id").alias("s_id"), F.col("row").alias("s_row"), *[f"n_{k}" for k in BASE],
                             text(base).alias("base"), text(F.col("all")).alias("spans"))
    rows = _keyed(docs).select("id", "row")
    joined = rows.join(per_row, F.col("id").eqNullSafe(F.col("s_id")) & (F.col("row") == F.col("s_row")), "left")
    return joined.select(
        F.col("id").alias("doc_id"), *[F.coalesce(F.col(f"n_{k}"), F.lit(0)).cast("long").alias(f"n_{k}") for k in BASE],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"), F.coalesce("spans", F.lit("")).alias("spans"))


def redacted(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``docs``, all columns, with every reported span replaced by ``[kind]``.

    ``n_chars``, where there is one, follows the text. Only texts with a candidate meet the spans in
    a join; all others pass as they are.
    """
    held = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col("text").rlike(_ANY), F.lit(False)).alias("suspect"))
    suspects = held.filter("suspect").select("doc")
    spans = scan(suspects.select("doc.doc_id", "doc.text"), scope)
    before = Window.partitionBy("id", "row").orderBy("start", F.desc("end")).rowsBetween(Window.unboundedPreceding, -1)
    spans = (spans.withColumn("done", F.coalesce(F.max("end").over(before), F.lit(0)))
             .filter(F.col("end") > F.col("done"))
             .groupBy("id", "row").agg(F.array_sort(F.collect_list(F.struct("start", "end", "done", "kind"))).alias("spans")))
    keyed = suspects.withColumns({"key": F.col("doc.doc_id").cast("long"), "code": F.xxhash64(F.coalesce("doc.text", F.lit("")))})
    joined = keyed.join(spans, F.col("key").eqNullSafe(F.col("id")) & (F.col("code") == F.col("row")), "left")
    text = F.col("doc.text")
    pieces = F.transform("spans", lambda s: F.concat(
        F.substring(text, (s["done"] + 1).cast("int"), F.greatest(s["start"] - s["done"], F.lit(0)).cast("int")),
        F.lit("["), s["kind"], F.lit("]")))
    last = F.element_at("spans", -1)["end"]
    clean = F.when(F.size("spans") > 0, F.concat(F.array_join(pieces, ""), F.substring(
        text, (last + 1).cast("int"), F.length(text)))).otherwise(text)
    doc = F.col("doc").withField("text", clean)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        doc = doc.withField("n_chars", F.when(F.size("spans") > 0, F.length(clean).cast(kind)).otherwise(F.col("doc.n_chars")))
    return held.filter("not suspect").select("doc.*").union(joined.select(doc.alias("doc")).select("doc.*"))
