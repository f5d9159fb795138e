"""The registered queries: thin wrappers that read whole tables and derive the digest columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read
from .op1_pu_quality import score_quality
from .op2_chat_format import canonical_turns, format_chats, parse_chats
from .op3_multiset_hash import document_fingerprints
from .op4_cube_mixing import mix_sources
from .op5_polynomial_dedup import exact_duplicates
from .op9_suffix_dedup import remove_repeats
from .op10_compression_toxicity import score_toxicity
from .op11_suffix_decontamination import contaminated_words
from .op12_structure_repair import damage, repair_conversations
from .op13_merkle_manifest import Manifest, document_leaves
from .op6_order_minhash import near_duplicates
from .op7_retrieval_packing import pack_documents
from .op8_feistel_shards import feistel_shards

CONTROL_CASE = "\\### Assistant: </turn> ok"


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    case = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.lit(CONTROL_CASE).alias("prompt"),
                                 F.lit(CONTROL_CASE).alias("response"))
    turns = canonical_turns(read(spark, sf_dir, "conversations")).unionByName(canonical_turns(case))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return parse_chats(format_chats(turns)).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op3_multiset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_fingerprints(read(spark, sf_dir, "documents"))


def op4_cube_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_polynomial_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read(spark, sf_dir, "documents")).drop("fingerprint")


def op6_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "kept")


def op7_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read(spark, sf_dir, "documents"))


def op8_feistel_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feistel_shards(read(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return remove_repeats(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"))


def op10_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_suffix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return contaminated_words(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations")
    mended = repair_conversations(damage(rows)).withColumnRenamed("conv_id", "_conv")
    text = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    number = lambda c: F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c)
    return rows.select("conv_id").distinct().join(mended, F.col("conv_id").eqNullSafe(F.col("_conv")), "left").select(
        "conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("repaired_sha256"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Manifest(document_leaves(read(spark, sf_dir, "documents"))).proofs().select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


QUERIES = {f.__name__: f for f in (
    op1_pu_quality, op2_chat_format, op3_multiset_hash, op4_cube_mixing, op5_polynomial_dedup, op6_order_minhash, op7_retrieval_packing,
    op8_feistel_shards, op9_suffix_dedup,
    op10_compression_toxicity, op11_suffix_decontamination, op12_structure_repair,
    op13_merkle_manifest)}

_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"



def _crc32(s: str) -> str:
    """crc32 of an ASCII string in DuckDB."""
    return (f"xor(4294967295, list_reduce([CAST(4294967295 AS BIGINT)] || list_transform(range(1, length({s}) + 1), "
            f"lambda i: CAST(ascii(substr({s}, i, 1)) AS BIGINT)), lambda c, b: list_reduce([xor(c, b)] || range(8), "
            "lambda v, k: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))))")


def _repair_sql() -> str:
    """The repair as a recursion over rows from the last to the first.  A path is a string, its cost
    in ten digits and its audit; least() of strings decides."""
    def before(edit: str, cost, path: str) -> str:
        return (f"lpad(CAST(CAST(substr({path}, 1, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || '{edit}' || substr({path}, 11)")
    late = "CASE WHEN fault = 'truncated' THEN 1 ELSE 0 END"
    stays = "fault NOT IN ('blank', 'duplicate')"

    def row(state: str, keep: dict, other: str) -> str:
        kept = " ".join(f"WHEN {stays} AND initial = '{i}' THEN {before('K', late, to)}" for i, to in keep.items())
        return (f"least({before('D', 3, state)}, CASE {kept} END, CASE WHEN {stays} THEN {before('R', f'2 + {late}', other)} END)")
    return f"""
        WITH RECURSIVE src AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        hurt AS (SELECT conv_id, turn, role, text, {_crc32('key')} % 20 AS k FROM src),
        t AS (
            SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
                   CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                   unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy FROM hurt WHERE k <> 0),
        o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
                     count(*) OVER (PARTITION BY conv_id) AS n FROM t),
        f AS (SELECT *, substr(role, 1, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said,
                     row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS nth,
                     lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM o),
        g AS (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                             WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault FROM f),
        p AS (
            SELECT conv_id, n AS i, '0000000000' AS e, '0000000004II' AS s, '0000000002I' AS u, '0000000000' AS a
            FROM (SELECT DISTINCT conv_id, n FROM o)
            UNION ALL
            SELECT conv_id, i, least(e, {before('I', 2, 'u')}), least(s, {before('I', 2, 'u')}), u, a FROM (
                SELECT conv_id, i, e, s, least(u, {before('I', 2, 'a')}) AS u, least(a, {before('I', 2, 'u')}) AS a FROM (
                    SELECT p.conv_id, p.i - 1 AS i, {row('e', {'s': 's', 'u': 'u'}, 'u')} AS e, {row('s', {'u': 'u'}, 'u')} AS s,
                           {row('u', {'a': 'a'}, 'a')} AS u, {row('a', {'u': 'u'}, 'u')} AS a
                    FROM p JOIN g ON p.conv_id IS NOT DISTINCT FROM g.conv_id AND p.i = g.i) rows_) inserted),
        best AS (SELECT conv_id, CAST(substr(e, 1, 10) AS BIGINT) AS cost, substr(e, 11) AS audit FROM p WHERE i = 0),
        edits AS (SELECT conv_id, audit, j, substr(audit, j, 1) AS edit,
                         length(replace(substr(audit, 1, j), 'I', '')) AS i, length(replace(substr(audit, 1, j), 'D', '')) AS place
                  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS j FROM best)),
        led AS (SELECT x.conv_id, bool_or(edit = 'K' AND place = 1 AND initial = 's') AS system FROM edits x
                JOIN g ON x.i = g.i AND x.conv_id IS NOT DISTINCT FROM g.conv_id GROUP BY x.conv_id),
        mended AS (SELECT x.conv_id, string_agg(CASE WHEN edit = 'K' THEN role
                          WHEN (place - CAST(coalesce(system, false) AS INTEGER)) % 2 = 1 THEN 'user' ELSE 'assistant' END
                          || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY j) AS text
                   FROM (SELECT * FROM edits WHERE edit <> 'D') x LEFT JOIN g ON x.i = g.i AND x.conv_id IS NOT DISTINCT FROM g.conv_id
                   LEFT JOIN led ON x.conv_id IS NOT DISTINCT FROM led.conv_id GROUP BY x.conv_id),
        counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                          count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                          count(*) FILTER (fault = 'truncated') AS truncated,
                          count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM g GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
               coalesce(audit, '') AS audit, sha256(coalesce(m.text, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c
        LEFT JOIN counts k ON c.conv_id IS NOT DISTINCT FROM k.conv_id
        LEFT JOIN best b ON c.conv_id IS NOT DISTINCT FROM b.conv_id
        LEFT JOIN mended m ON c.conv_id IS NOT DISTINCT FROM m.conv_id"""


def _merkle_sql(levels: int = 9) -> str:
    """Both trees level by level (``levels`` of them: up to 8^9 nodes each), siblings joined on the way."""
    part = lambda v: f"coalesce(CAST(strlen(CAST({v} AS VARCHAR)) AS VARCHAR) || ':' || CAST({v} AS VARCHAR), '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    sql = [f"""d AS (SELECT row_number() OVER () AS r, doc_id, lang, {leaf('text')} AS leaf,
                 CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN {leaf(lower)} ELSE {leaf('text')} END AS claim FROM documents),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d),
        low0 AS (SELECT lang AS g, pos, leaf AS h FROM ranked),
        way0 AS (SELECT r, lang AS g, pos, claim AS h, '' AS proof FROM ranked)"""]

    def climb(name: str) -> None:
        for k in range(levels):
            sql.append(f"""{name}run{k} AS (SELECT g, pos // 8 AS run, list(h ORDER BY pos) AS hs,
                 sum(count(*)) OVER (PARTITION BY g) > 1 AS more FROM {name}{k} GROUP BY g, pos // 8)""")
            sql.append(f"""{name}{k + 1} AS (SELECT g, run AS pos, CASE WHEN more THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h
                 FROM {name}run{k})""")
            sql.append(f"""way{name}{k + 1} AS (SELECT w.r, w.g, run AS pos,
                 CASE WHEN more THEN sha256(array_to_string(hs[1 : w.pos % 8] || [w.h] || hs[w.pos % 8 + 2 :], '')) ELSE w.h END AS h,
                 w.proof || CASE WHEN more THEN array_to_string(hs[1 : w.pos % 8] || hs[w.pos % 8 + 2 :], '') ELSE '' END AS proof
                 FROM way{name}{k} w JOIN {name}run{k} n ON w.g IS NOT DISTINCT FROM n.g AND w.pos // 8 = n.run)""")
    sql[0] = sql[0].replace("way0", "waylow0")
    climb("low")
    sql.append(f"""langs AS (SELECT g AS lang, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS pos FROM low{levels}),
        top0 AS (SELECT 0 AS g, pos, h FROM langs),
        waytop0 AS (SELECT w.r, 0 AS g, l.pos, w.h, w.proof FROM waylow{levels} w JOIN langs l ON w.g IS NOT DISTINCT FROM l.lang)""")
    climb("top")
    return "WITH " + ",\n        ".join(sql) + f"""
        SELECT doc_id, leaf, l.h AS subroot, t.h AS root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = t.h AS verified
        FROM d JOIN langs l ON d.lang IS NOT DISTINCT FROM l.lang JOIN waytop{levels} w ON d.r = w.r CROSS JOIN top{levels} t"""


ORACLE_SQL = {
    "op2_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(16 + length(role) + length(text)
                   + length(role) - length(replace(replace(replace(role, '\', ''), '<', ''), '>', ''))
                   + length(text) - length(replace(replace(text, '\', ''), '<', ''))) AS BIGINT) AS formatted_chars
        FROM t GROUP BY conv_id""",
    "op5_polynomial_dedup": """
        WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
                   FROM documents)
        SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM t""",
    "op11_suffix_decontamination": rf"""
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM documents),
        b AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all({_LOWERED}, '{_WORD}') AS w FROM benchmark),
        starts AS (
            SELECT item, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS s FROM b WHERE len(w) > 0),
        windows AS (SELECT DISTINCT item, k, array_to_string(w[s : s + k - 1], ' ') AS t FROM starts),
        sizes AS (SELECT DISTINCT k FROM windows),
        words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
        places AS (SELECT r, p, list(x) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w FROM words),
        tried AS (SELECT r, p, k, array_to_string(w[1 : k], ' ') AS t FROM places JOIN sizes ON k <= len(w)),
        met AS (SELECT r, p, k, item FROM tried JOIN windows USING (k, t)),
        hit AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + k)) AS q FROM (SELECT DISTINCT r, p, k FROM met)) GROUP BY r),
        items AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT r, item FROM met) GROUP BY r)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, hit.n IS NOT NULL AS contaminated
        FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)""",
    "op12_structure_repair": _repair_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
