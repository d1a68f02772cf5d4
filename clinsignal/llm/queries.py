"""One query per operator over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clinsignal.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    langid,
    licences,
    manifest,
    minhash,
    mixing,
    packing,
    pii,
    secrets,
    sharding,
    tokens,
)
from clinsignal.llm.common import table


def tokenizer_file(name: str = tokens.TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of benchmark passages in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words every document gives to the mix."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("bigint").alias("taken"), "copies"
    )


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of the labels."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs)
    said = langid.identify(docs.select("doc_id", "text"), model)
    return said.select(
        "doc_id",
        F.coalesce(langid.remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


def op4_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices of every document."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda h: h["licence"])))
    return found.select(
        "doc_id",
        F.size("hits").cast("bigint").alias("n_hits"),
        F.concat_ws(",", names).alias("licences"),
        F.concat_ws(",", F.transform("hits", lambda h: h["line"].cast("string"))).alias("lines"),
        F.round(F.array_max(F.transform("hits", lambda h: h["dice"])), 6).alias("best"),
    )


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        *[F.size(k).cast("bigint").alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(secrets.joined_spans(["assign", "access", "hex"]), 256).alias("base_sha256"),
        secrets.joined_spans(["assign", "access", "hex", "random"]).alias("spans"),
        F.size("random").cast("bigint").alias("n_random"),
    )


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; counts differ by at most one."""
    return sharding.shard_rows(table(spark, sf_dir, "documents"), 16).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data and disclosing terms of every document."""
    found = pii.detect(table(spark, sf_dir, "documents"))
    base = [(k, pii.of_kind(k)) for k in pii.KINDS]
    terms = [(a, pii.of_action(a)) for a in ("generalise", "remove")]
    return found.select(
        "doc_id",
        *[F.size(spans).cast("bigint").alias(f"n_{k}") for k, spans in base],
        F.sha2(pii.listed_spans(base), 256).alias("base_sha256"),
        pii.listed_spans(base + terms).alias("spans"),
        F.size("terms").cast("bigint").alias("n_terms"),
    )


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids, written to coded blocks and read back."""
    _, path = tokens.write_tokens(table(spark, sf_dir, "documents"), tokenizer_file())
    return tokens.read_tokens(spark, path)


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components over two-word shingles."""
    return minhash.near_groups(table(spark, sf_dir, "documents"), width=2)


MANIFEST_FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merkle manifest of all documents, a tree per language; one row in seven is tampered with."""
    more = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("string")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    docs = table(spark, sf_dir, "documents")
    return manifest.manifest(docs, MANIFEST_FIELDS, "lang", altered={"n_chars": more}, where=tampered)


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's token ids in sequences of at most 4096."""
    placed = packing.pack_sequences(table(spark, sf_dir, "documents"), tokenizer_file())
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "loss_tokens")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token groups and links of every document under two tokenizers."""
    docs = table(spark, sf_dir, "documents")
    return alignment.Alignment(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")).documents()


QUERIES = {
    f.__name__: f
    for f in (
        op1_decontaminate,
        op2_mixing,
        op3_language,
        op4_licences,
        op5_secrets,
        op6_exact_dedup,
        op7_sharding,
        op8_pii,
        op9_tokens,
        op10_minhash,
        op11_manifest,
        op12_packing,
        op13_alignment,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLES = {
    "op1_decontaminate": f"""
        WITH d AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
        b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
        win AS (
            SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
                SELECT item, w, least(10, len(w)) AS k, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
                FROM b WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT k FROM win),
        grams AS (
            SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (
                SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
        hits AS (SELECT g.doc_id, win.item, g.i, g.k FROM grams g JOIN win ON g.phrase = win.phrase AND g.k = win.k),
        per_item AS (SELECT DISTINCT doc_id, item FROM hits),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM per_item GROUP BY doc_id),
        places AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hits) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
               CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN items USING (doc_id) LEFT JOIN places USING (doc_id)
    """,
    "op6_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM (
            SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                   sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW g AS (PARTITION BY coalesce(text, '')))
    """,
}


def licence_oracle() -> str:
    known = licences.template_bigrams(licences.TEMPLATES)
    rows = ", ".join(
        "('{}', [{}], CAST([{}] AS VARCHAR[]))".format(t["name"], *(", ".join(f"'{g}'" for g in t[c]) for c in ("grams", "must")))
        for t in known
    )
    return f"""
        WITH templates AS (SELECT * FROM (VALUES {rows}) AS t(licence, grams, must)),
        lines AS (
            SELECT doc_id, i - 1 AS line, list_filter(string_split(l[i], ' '), lambda x: x <> '') AS w FROM (
                SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (
                    SELECT doc_id, string_split(lower(regexp_replace(text, '[^A-Za-z0-9\\n]+', ' ', 'g')), chr(10)) AS l
                    FROM documents))),
        grams AS (
            SELECT doc_id, line, list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS g
            FROM lines WHERE len(w) > 1),
        scored AS (
            SELECT doc_id, line, licence, 2.0 * len(list_intersect(g, grams)) / (len(g) + len(grams)) AS dice
            FROM grams, templates WHERE list_has_any(g, grams) AND list_has_all(g, must)),
        best AS (
            SELECT doc_id, line, max(dice) AS dice, arg_min(licence, (-dice, licence)) AS licence
            FROM scored WHERE dice >= {licences.THRESHOLD} GROUP BY doc_id, line),
        per_doc AS (
            SELECT doc_id, count(*) AS n_hits, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) AS lines,
                   array_to_string(list_sort(list_distinct(list(licence))), ',') AS licences, round(max(dice), 6) AS best
            FROM best GROUP BY doc_id)
        SELECT doc_id, CAST(coalesce(n_hits, 0) AS BIGINT) AS n_hits, coalesce(licences, '') AS licences,
               coalesce(lines, '') AS lines, best
        FROM documents LEFT JOIN per_doc USING (doc_id)
    """


ORACLES["op4_licences"] = licence_oracle()


def manifest_oracle() -> str:
    fields = " || ".join(
        f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in MANIFEST_FIELDS
    )
    altered = fields.replace("CAST(n_chars AS VARCHAR)", "CAST(CAST(n_chars AS HUGEINT) + 1 AS VARCHAR)")
    step = "list_reduce(range(0, 8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, xor(c, b))"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))"
    crc = f"xor(list_reduce({codes}, lambda c, b: {step}, CAST(4294967295 AS BIGINT)), 4294967295)"
    return f"""
        WITH RECURSIVE leaves AS (
            SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS pos, sha256({fields}) AS leaf,
                   CASE WHEN ({crc}) % 7 = 0 THEN sha256({altered}) ELSE sha256({fields}) END AS shown FROM documents),
        low AS (
            SELECT lang, 0 AS level, pos, leaf AS digest, count(*) OVER (PARTITION BY lang) AS n FROM leaves
            UNION ALL
            SELECT lang, level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
            FROM low WHERE n > 1 GROUP BY lang, level, pos // 2, n),
        tops AS (
            SELECT lang, digest AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos
            FROM low WHERE n = 1),
        high AS (
            SELECT 0 AS level, pos, subroot AS digest, count(*) OVER () AS n FROM tops
            UNION ALL
            SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos)), (n + 1) // 2
            FROM high WHERE n > 1 GROUP BY level, pos // 2, n),
        low_steps AS (
            SELECT l.lang, l.doc_id, list({{'side': (l.pos >> b.level) % 2, 'd': coalesce(s.digest, '')}} ORDER BY b.level) AS steps
            FROM leaves l
            JOIN (SELECT DISTINCT lang, level FROM low WHERE n > 1) b ON b.lang IS NOT DISTINCT FROM l.lang
            LEFT JOIN low s ON s.lang IS NOT DISTINCT FROM l.lang AND s.level = b.level AND s.pos = xor(l.pos >> b.level, 1)
            GROUP BY ALL),
        high_steps AS (
            SELECT t.lang, list({{'side': (t.pos >> b.level) % 2, 'd': coalesce(s.digest, '')}} ORDER BY b.level) AS steps
            FROM tops t, (SELECT DISTINCT level FROM high WHERE n > 1) b
            LEFT JOIN high s ON s.level = b.level AND s.pos = xor(t.pos >> b.level, 1)
            GROUP BY ALL),
        proofs AS (
            SELECT l.doc_id, l.leaf, l.shown, t.subroot, r.digest AS root,
                   list_concat(coalesce(a.steps, []), coalesce(h.steps, [])) AS steps
            FROM leaves l JOIN tops t ON t.lang IS NOT DISTINCT FROM l.lang
            LEFT JOIN low_steps a ON a.doc_id = l.doc_id
            LEFT JOIN high_steps h ON h.lang IS NOT DISTINCT FROM l.lang
            CROSS JOIN (SELECT digest FROM high WHERE n = 1) r),
        folded AS (
            SELECT *, list_reduce(list_transform(steps, lambda s: CAST(s.side AS VARCHAR) || s.d), lambda x, s:
                       CASE WHEN s[1] = '1' THEN sha256(s[2:] || x) ELSE sha256(x || s[2:]) END, shown) AS folded_root
            FROM proofs)
        SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(steps, lambda s: s.d), '')) AS proof_sha256,
               folded_root, folded_root = root AS verified
        FROM folded
    """


ORACLES["op11_manifest"] = manifest_oracle()
