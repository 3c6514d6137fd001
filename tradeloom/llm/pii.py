"""Personal data by patterns of form, and by bootstrapped patterns of context.

Four kinds have a form: e-mail and IP addresses, card and phone numbers. Their matches are seeds. The words around
seeds induce lexical patterns; patterns and what they surround, seeds and other identifier-like strings, are a graph.
A pattern is worth the share of its instances that are known to be of a kind, an instance what its patterns are worth
together, and both are computed in turns. Strings that trusted patterns surround are found as well.

All of it is DataFrame functions. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.frames import keep

#: The forms, each written so that Java's matcher needs linear time: possessive where giving back cannot help, and no
#: start inside a run that a match would have begun with, unless the match before ended there (\\G).
KINDS = ["email", "ip", "card", "phone"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9]){15,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
#: What else may be an identifier: a string from a digit on, of six characters or more.
OTHER = r"(?<![A-Za-z0-9.@+-])[0-9][0-9A-Za-z._@()-]{4,}[0-9A-Za-z]"

OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[0-9]{1,2})"

ROUNDS = 3
LEAST_KNOWN = 5  # distinct known instances that a pattern must surround
TRUST_PATTERN = 0.8
TRUST_INSTANCE = 0.9
BROADCAST_ROWS = 10_000  # beyond so many documents with discoveries they are joined by a shuffle

FOUND = "array<struct<start:bigint,end:bigint,surface:string,left:string,right:string>>"
SPANS = "array<struct<kind:int,start:bigint,end:bigint>>"


def _places(found: Column, between: Column) -> Column:
    """Matches with their places and the text on both sides of them, from the matches and the pieces between them."""
    steps = F.transform(found, lambda m, i: F.struct(
        m.alias("m"), F.get(between, i).alias("before"), F.get(between, i + 1).alias("after")))

    def add(done: Column, step: Column) -> Column:
        start = done["at"] + F.char_length(step["before"])
        end = start + F.char_length(step["m"])
        one = F.struct(start.alias("start"), end.alias("end"), step["m"].alias("surface"),
                       F.right(step["before"], F.lit(60)).alias("left"), F.left(step["after"], F.lit(30)).alias("right"))
        return F.struct(end.alias("at"), F.concat(done["found"], F.array(one)).cast(FOUND).alias("found"))

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(FOUND).alias("found"))
    return F.aggregate(steps, none, add, lambda done: done["found"])


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
        F.when(d.cast("int") > 4, d.cast("int") * 2 - 9).otherwise(d.cast("int") * 2)))
    return F.aggregate(values, F.lit(0), lambda a, v: a + F.coalesce(v, F.lit(0))) % 10 == 0


def _digits(surface: Column) -> Column:
    return F.regexp_replace(surface, "[^0-9]", "")


def _fits(kind: str, surface: Column) -> Column:
    if kind == "ip":
        return surface.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$")
    if kind == "card":
        digits = _digits(surface)
        return F.char_length(digits).between(16, 19) & luhn(digits)
    if kind == "phone":
        return F.char_length(_digits(surface)).between(8, 15)
    return F.lit(True)


def searched(df: DataFrame, text: str, others: bool = False) -> DataFrame:
    """``df`` with a column for each kind: the matches of ``text`` that fit it, leftmost and without overlap.

    ``others`` adds the column other. Texts without a kind's characters are not searched for it. Each step is a
    projection of its own, so that no expression is computed for every use of it.
    """
    forms = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE))) | ({"other": OTHER} if others else {})
    whole, digit = F.col(text), F.col("has_digit")
    worth = {"email": F.contains(whole, F.lit("@")), "ip": digit & F.contains(whole, F.lit(".")), "card": digit,
             "phone": F.contains(whole, F.lit("+")), "other": digit}
    none = F.array().cast("array<string>")
    df = df.withColumn("has_digit", whole.rlike("[0-9]"))
    df = df.withColumns(
        {f"{k}_found": F.when(worth[k], F.regexp_extract_all(whole, F.lit(form), F.lit(0))).otherwise(none) for k, form in forms.items()}
        | {f"{k}_between": F.when(worth[k], F.split(whole, form, -1)).otherwise(none) for k, form in forms.items()})

    def fitting(kind: str) -> Column:
        return F.filter(_places(F.col(f"{kind}_found"), F.col(f"{kind}_between")), lambda x: _fits(kind, x["surface"]))

    return df.withColumns({k: fitting(k) for k in forms}).drop(
        "has_digit", *[f"{k}_found" for k in forms], *[f"{k}_between" for k in forms])


def spans_of_kinds() -> Column:
    """The columns that ``searched`` adds as spans, by kind and start."""
    def of(kind: int) -> Column:
        return F.transform(KINDS[kind], lambda x: F.struct(
            F.lit(kind).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))

    return F.concat(*[of(i) for i in range(len(KINDS))]).cast(SPANS)


def _word(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[^\p{L}]", ""))


def contexts(left: Column, right: Column) -> Column:
    """The lexical patterns of a place: the two words before it; the words on both sides. Those with a gap are none."""
    last = _word(F.regexp_extract(left, r"(\S+)\s*$", 1))
    second = _word(F.regexp_extract(left, r"(\S+)\s+\S+\s*$", 1))
    following = _word(F.regexp_extract(right, r"^\S*\s+(\S+)\s", 1))
    patterns = F.array(
        F.when((last != "") & (second != ""), F.concat(second, F.lit(" "), last, F.lit(" *"))),
        F.when((last != "") & (following != ""), F.concat(last, F.lit(" * "), following)))
    return F.filter(patterns, lambda p: p.isNotNull())


def occurrences() -> Column:
    """Seeds and other identifier-like strings with the text around them; others that overlap a span of base are left out."""
    def held(x: Column, kind: Column) -> Column:
        return F.struct(kind.cast("int").alias("kind"), *[x[c].alias(c) for c in ("start", "end", "surface", "left", "right")])

    def seen(kind: int) -> Column:
        return F.transform(KINDS[kind], lambda x: held(x, F.lit(kind)))

    apart = F.filter("other", lambda x: ~F.exists("base", lambda s: (s["start"] < x["end"]) & (x["start"] < s["end"])))
    others = F.transform(apart, lambda x: held(x, F.lit(None).cast("int")))
    return F.concat(*[c.cast(FOUND.replace("<start", "<kind:int,start")) for c in (*map(seen, range(len(KINDS))), others)])


def bootstrap(places: DataFrame) -> DataFrame:
    """(instance, kind): instances found by context, from rows (kind or null, instance, patterns).

    In each round a pattern's worth for a kind is the summed worth of its distinct instances over their number, two
    more counted in; it is trusted from TRUST_PATTERN on with LEAST_KNOWN known instances. An unknown instance is worth
    one minus the product of what its trusted patterns lack, and is known from TRUST_INSTANCE on. An instance that
    patterns of two kinds find is of the kind that it is worth more for, then the first.
    """
    edges = keep(places.select("instance", F.explode("patterns").alias("pattern")).distinct())
    seeds_known = keep(places.where("kind IS NOT NULL").groupBy("instance").agg(F.min("kind").alias("kind")))
    size = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    size = keep(size.where(F.col("n") >= LEAST_KNOWN))
    edges = keep(edges.join(size, "pattern"))
    known = seeds_known.withColumn("worth", F.lit(1.0))
    found = known.limit(0)
    for _ in range(ROUNDS):
        worth = (
            edges.join(known, "instance").groupBy("pattern", "kind", "n")
            .agg(F.sum("worth").alias("sum"), F.count(F.lit(1)).alias("members"))
            .select("pattern", "kind", (F.col("sum") / (F.col("n") + 2)).alias("pattern_worth"), "members")
            .where((F.col("members") >= LEAST_KNOWN) & (F.col("pattern_worth") >= TRUST_PATTERN))
        )
        scored = (
            edges.join(worth, "pattern").join(seeds_known.select("instance"), "instance", "left_anti")
            .groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("pattern_worth"))))).alias("worth"))
            .where(F.col("worth") >= TRUST_INSTANCE)
        )
        best = scored.groupBy("instance").agg(F.max(F.struct("worth", (-F.col("kind")).alias("back"))).alias("best"))
        found = keep(best.select("instance", (-F.col("best.back")).alias("kind"), F.col("best.worth").alias("worth")))
        known = seeds_known.withColumn("worth", F.lit(1.0)).unionByName(found)
    return found.select("instance", "kind")


def examined(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, content, base, places) of every row, written once: a hash of the text, its spans, its occurrences."""
    rows = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = searched(rows, "text", others=True).withColumn("base", spans_of_kinds())
    return keep(rows.select("key", F.xxhash64("text").alias("content"), "base", occurrences().alias("places")))


def discovered(rows: DataFrame) -> DataFrame:
    """(key, content, more): the spans that ``bootstrap`` adds to a document, for those that have any."""
    places = rows.select("key", "content", F.explode("places").alias("place")).select("key", "content", "place.*")
    places = keep(places.select("key", "content", "kind", "start", "end", F.lower("surface").alias("instance"),
                                contexts(F.col("left"), F.col("right")).alias("patterns")))
    known = bootstrap(places.select("kind", "instance", "patterns")).withColumnRenamed("kind", "found_kind")
    return (
        places.where("kind IS NULL").join(known, "instance")
        .select("key", "content", F.struct(F.col("found_kind").alias("kind"), "start", "end").alias("span")).distinct()
        .groupBy("key", "content").agg(F.collect_list("span").cast(SPANS).alias("more"))  # of one document
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, by kind and start, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, base, spans) of every row: spans by form, and with those found by context, as arrays.

    A null or empty text has none. Rows alike in key and text share their findings, repeated rows are kept; an empty
    frame gives none. Null keys are keys. Other columns are not looked at. A very long text is searched whole.
    """
    rows = examined(df, key, text)
    more = discovered(rows).select(F.col("key").alias("of"), F.col("content").alias("held"), "more")
    joined = rows.join(more, F.col("key").eqNullSafe(F.col("of")) & (F.col("content") == F.col("held")), "left")
    spans = F.sort_array(F.concat("base", F.coalesce("more", F.array().cast(SPANS))))
    return joined.select(F.col("key").alias(key), F.sort_array("base").alias("base"), spans.alias("spans"))


def masked(text: Column, spans: Column) -> Column:
    """``text`` with ``<KIND>`` in place of each span; of spans that overlap the first stands for them all."""
    names = F.array(*[F.lit(f"<{k.upper()}>") for k in KINDS])
    by_start = F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    shape = "struct<at:bigint,parts:array<string>>"

    def add(done: Column, s: Column) -> Column:
        piece = F.substr(text, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        apart = F.concat(done["parts"], F.array(piece, F.get(names, s["kind"])))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= done["at"], apart).otherwise(done["parts"]).alias("parts")).cast(shape)

    none = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts")).cast(shape)
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(by_start, none, add, lambda done: F.concat(
        F.array_join(done["parts"], ""), F.substr(text, (done["at"] + 1).cast("int")))))


def mask(df: DataFrame, key: str, text: str) -> DataFrame:
    """``df`` with personal data in ``text`` replaced by the name of its kind; other columns, whatever their names, stay.

    A null text stays null. See ``find`` for what is found. The texts do not move: discoveries are joined to them as
    a broadcast of at most BROADCAST_ROWS documents, beyond that by a shuffle.
    """
    more = keep(discovered(examined(df, key, text)))
    if more.count() <= BROADCAST_ROWS:
        more = F.broadcast(more)
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), F.col(text).alias("plain"), F.col(key).alias("of"),
                     F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("held"))
    rows = searched(rows, "plain").withColumn("base", spans_of_kinds())
    joined = rows.join(more, F.col("of").eqNullSafe(F.col("key")) & (F.col("held") == F.col("content")), "left")
    joined = joined.withColumn("all", F.concat("base", F.coalesce("more", F.array().cast(SPANS))))
    safe = F.when(F.col("plain").isNotNull(), masked(F.col("plain"), F.col("all")))
    return joined.select(*[safe.alias(c) if c == text else F.col(f"row.`{c}`") for c in df.columns])
