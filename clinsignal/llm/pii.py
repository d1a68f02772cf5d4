"""Personal data: fixed patterns plus information-theoretic sanitisation.

Protected entities are the values the patterns find (mail and IP addresses,
card and phone numbers).  A term of the same document can give an entity away
even when the value itself is masked.  How strongly is estimated from the whole
corpus: the point-wise mutual information of entity and term, as a share of the
information the entity itself carries,

    log(n(e,t) / (n(t) + SMOOTHING) * N / n(e)) / log(N / n(e))

with n(e) occurrences of the entity, n(t) of the term, n(e,t) of the term in
documents that hold the entity, N terms in all.  It comes close to 1 when the
term occurs in no other document; ``SMOOTHING`` lowers it the more, the fewer
occurrences back it, so an entity seen once is judged like any other.  Terms
from ``GENERALISE`` on are generalised, from ``REMOVE`` on removed, by the
entity of the document they tell most about; texts without personal data stay
as they are.  A term is a run of four letters or more (``TERM``).

Native expressions only.  Term counts are partial aggregates over every text.
Entities found in exactly the same documents are one group: they share n(e,t),
and the share falls with n(e), so the group's rarest entity decides for it.
All entities of no other document make one group, so pairs of group and term
are linear in the documents but for entities that several documents share in
different combinations.  Joins on hot pairs are split by AQE's skew join.

Defined results: a null text counts as empty; repeated rows get the same
spans each; terms overlapping a pattern span are left to it; null ids work
like any other id; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinsignal.llm.common import match_spans, span_text, store, text_key

# The patterns every scan reports, in the order of their kinds.
# Possessive and look-behind forms of the plain patterns: the same matches in
# linear time (\G allows a match right after the previous one).
KINDS = ("email", "ip", "card", "phone")
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

TERM = r"\p{L}{4,}"
MASK = "\uffff"  # a code point that is no character, in place of those of an address
FREE_TERM = rf"(?<![\p{{L}}{MASK}])\p{{L}}{{4,}}+(?!{MASK})"  # whole words beside no masked address
REACH = 1 << 30  # code points on either side of an entity: more than a text has, all of it counts
MIN_SUPPORT = 1  # joint occurrences of a pair: all count
SMOOTHING = 1.0
GENERALISE = 0.80
REMOVE = 0.95


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def is_ip(match: Column) -> Column:
    parts = F.transform(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(parts, lambda p: (F.length(p) <= 3) & (F.coalesce(p.try_cast("int"), F.lit(0)) <= 255))


def is_card(match: Column) -> Column:
    d = digits(match)

    def doubled(c, i):
        v = c.try_cast("int")
        return F.when(i % 2 == 1, v * 2 - F.when(v > 4, 9).otherwise(0)).otherwise(v)

    total = F.aggregate(F.transform(F.split(F.reverse(d), ""), doubled), F.lit(0), lambda a, b: a + b)
    return F.length(d).between(16, 19) & (total % 10 == 0)


def raw_spans(text: Column) -> dict[str, Column]:
    """Every pattern's matches before validation, with the text between them."""
    has_digit = text.rlike("[0-9]")
    return {
        "email": match_spans(text, EMAIL, text.contains("@"), tail=True),
        "ip": match_spans(text, IP, has_digit, tail=True),
        "card": match_spans(text, CARD, has_digit, tail=True),
        "phone": match_spans(text, PHONE, text.contains("+"), tail=True),
    }


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return is_ip(match)
    if kind == "card":
        return is_card(match)
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    return F.lit(True)


def entities(kind: str, spans: Column) -> Column:
    """Valid spans as structs of kind, start, end and entity."""
    found = F.filter(spans, lambda s: s["match"].isNotNull() & valid(kind, s["match"]))
    return F.transform(
        found,
        lambda s: F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.lower(s["match"]).alias("entity"),
        ),
    )


def free_terms(text: Column, emails: Column) -> Column:
    """(term, start, end) of every term that overlaps no pattern span: of all kinds, only addresses have letters."""
    pieces = F.transform(
        emails, lambda s: F.concat(s["left"], F.repeat(F.lit(MASK), F.coalesce(F.length(s["match"]), F.lit(0))))
    )
    masked = F.when(F.size(emails) > 0, F.array_join(pieces, "")).otherwise(text)
    return F.transform(
        match_spans(masked, FREE_TERM),
        lambda t: F.struct(F.lower(t["match"]).alias("term"), t["start"].alias("start"), t["end"].alias("end")),
    )


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pattern pass: id, text hash, validated base spans and, where there are any, the document's terms."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = docs.select(
        F.col(id_col).alias("id"),
        text.alias("t"),
        *[s.alias(k) for k, s in raw_spans(text).items()],
    )
    found = raw.select("id", "t", "email", F.concat(*[entities(k, F.col(k)) for k in KINDS]).alias("base"))
    none = F.expr("cast(array() as array<struct<term:string,start:int,end:int>>)")
    return found.select(
        "id",
        F.xxhash64("t").alias("th"),
        text_key(F.col("id")).alias("key"),
        "base",
        F.when(F.size("base") > 0, free_terms(F.col("t"), F.col("email"))).otherwise(none).alias("words"),
    )


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Occurrences of every term of the corpus."""
    words = F.regexp_extract_all(F.col(text_col), F.lit(TERM), F.lit(0))
    return docs.select(F.explode(words).alias("w")).groupBy(F.lower("w").alias("term")).agg(F.count(F.lit(1)).alias("n_t"))


def disclosures(scanned: DataFrame, terms: DataFrame, min_support: int = MIN_SUPPORT) -> tuple[DataFrame, DataFrame]:
    """(group, term, share): how much of its rarest entity's information a term gives away; and each document's groups."""
    total = terms.agg(F.sum("n_t")).first()[0] or 0
    held = (
        scanned.select("key", "th", F.explode("base").alias("e"))
        .groupBy("key", "th", "e.entity")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    single = held.groupBy("entity").agg(
        F.sum("n").alias("n_e"),
        F.struct(
            F.count(F.lit(1)).alias("docs"),
            F.bit_xor(F.xxhash64("key", "th")).alias("h1"),
            F.bit_xor(F.xxhash64(F.lit("second"), "th", "key")).alias("h2"),
        ).alias("group"),
    )
    rarest = single.groupBy("group").agg(F.min("n_e").alias("n_e"))
    groups, _ = store(held.join(single.select("entity", "group"), "entity").select("key", "th", "group").distinct(), "pii-groups")
    words = (
        scanned.select("key", "th", F.explode("words").alias("w"))
        .groupBy("key", "th", "w.term")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joint = groups.join(words, ["key", "th"]).groupBy("group", "term").agg(F.sum("n").alias("n_et"))
    counted = joint.where(F.col("n_et") >= min_support).join(terms, "term").join(rarest, "group")
    pmi = F.log(F.col("n_et") / (F.col("n_t") + F.lit(SMOOTHING)) * F.lit(float(total)) / F.col("n_e"))
    carried = F.log(F.lit(float(max(total, 1))) / F.col("n_e"))
    told = counted.where(carried > 0).select("group", "term", (pmi / carried).alias("share"))
    return told, groups


def detect(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_support: int = MIN_SUPPORT,
    generalise: float = GENERALISE,
    remove: float = REMOVE,
) -> DataFrame:
    """One row per document: id, text hash, base spans, and term spans with action."""
    scanned, _ = store(scan(docs, id_col, text_col), "pii-spans")
    terms, _ = store(term_counts(docs, text_col), "pii-terms")
    shares, groups = disclosures(scanned, terms, min_support)
    told, _ = store(shares.where(F.col("share") >= generalise), "pii-told")
    # the strongest action of a document's entities; a repeated row finds its spans twice, the set keeps one of each
    actions = groups.join(told, "group").groupBy("key", "th", "term").agg(F.max("share").alias("share"))
    hits = (
        scanned.select("key", "th", F.explode("words").alias("w"))
        .select("key", "th", "w.term", "w.start", "w.end")
        .join(actions, ["key", "th", "term"])
        .withColumn("action", F.when(F.col("share") >= remove, "remove").otherwise("generalise"))
        .groupBy("key", "th")
        .agg(F.collect_set(F.struct("start", "end", "action")).alias("terms"))
    )
    none = F.expr("cast(array() as array<struct<start:int,end:int,action:string>>)")
    return scanned.select("id", "key", "th", "base").join(hits, ["key", "th"], "left").select(
        F.col("id").alias(id_col), "th", "base", F.coalesce(F.array_sort("terms"), none).alias("terms")
    )


def listed_spans(kinds: list[tuple[str, Column]]) -> Column:
    """kind:start:end by kind as listed, then start, comma-joined."""
    def tag(kind: str, spans: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"], x["end"])))
        return F.transform(ordered, lambda x: span_text(kind, x))

    return F.concat_ws(",", F.concat(*[tag(k, s) for k, s in kinds]))


def of_kind(kind: str) -> Column:
    return F.filter("base", lambda s: s["kind"] == KINDS.index(kind))


def of_action(action: str) -> Column:
    return F.filter("terms", lambda s: s["action"] == action)


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with personal data masked, disclosing terms generalised to
    ``[WORD]`` or removed.  Overlapping spans are replaced once, from the first."""
    marks = F.concat(
        F.transform("base", lambda s: F.struct(s["start"], s["end"], F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)), F.lit("]")).alias("put"))),
        F.transform("terms", lambda s: F.struct(s["start"], s["end"], F.when(s["action"] == "remove", "").otherwise("[WORD]").alias("put"))),
    )
    spans = detect(docs, id_col, text_col, **options).select(
        text_key(F.col(id_col)).alias("_key"), F.col("th").alias("_th"), F.array_sort(marks).alias("_marks")
    ).dropDuplicates(["_key", "_th"])
    text = F.coalesce(F.col(text_col), F.lit(""))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def put(acc, m):
        piece = F.substring(text, acc["at"] + 1, F.greatest(m["start"] - acc["at"], F.lit(0)))
        step = F.struct(m["end"].alias("at"), F.concat(acc["out"], piece, m["put"]).alias("out"))
        return F.when(m["start"] < acc["at"], acc).otherwise(step)

    rebuilt = F.aggregate(
        "_marks", start, put, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )
    keyed = docs.withColumn("_key", text_key(F.col(id_col))).withColumn("_th", F.xxhash64(text))
    return (
        keyed.join(spans, ["_key", "_th"], "left")
        .withColumn(text_col, F.when(F.size("_marks") > 0, rebuilt).otherwise(F.col(text_col)))
        .select(*docs.columns)
    )
