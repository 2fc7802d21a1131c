"""The registered queries of this subpackage: each applies one operator to its whole table.

``QUERIES`` maps a key to ``fn(spark, sf_dir)``, ``ORACLES`` a key to DuckDB SQL with the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from provisio.llm import alignment, decontam, language, lm, mixing, quality, setjoin, sharding, substrings, suffixes, tokens, trie, warc
from provisio.llm.store import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
SHARDS = 24


def query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        return fn

    return add


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_files")
def _tokens(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    manifest = tokens.write_tokens(docs, vocabulary(), END_ID)
    return tokens.read_documents(spark, manifest)


@query("op4_best_fit_shards")
def _shards(spark, sf_dir):
    placed = sharding.shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op7_cube_mix")
def _mix(spark, sf_dir):
    mixed = mixing.copies(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query("op8_warc_members")
def _warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.col("html").cast("binary").alias("payload"))
    return warc.archive(pages).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op10_weak_supervision")
def _quality(spark, sf_dir):
    measured = store(quality.measure(table(spark, sf_dir, "documents")), "quality")
    judged = quality.judge(measured, quality.fit(measured))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


@query("op5_string_kernel")
def _language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = language.fit(docs.filter(~held_out).select("text", "lang"), "lang")
    told = language.predict(docs, model)
    return told.select("doc_id", held_out.alias("held_out"), F.col("label").alias("lang_pred"), "score")


@query("op6_simhash_decontamination")
def _leaks(spark, sf_dir):
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op3_block_anchors")
def _substrings(spark, sf_dir):
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op2_segment_pigeonhole")
def _jaccard(spark, sf_dir):
    return setjoin.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=85).select("doc_id", "n_shingles", "component_id", "class_id")


@query("op9_attention_scores")
def _lm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    remainder = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7
    scored = lm.score(docs, vocabulary(), remainder != 2)
    return scored.select("doc_id", F.coalesce(remainder == 2, F.lit(False)).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op11_depth_limited_sort", """
    with d as (
      select row_number() over () as r, doc_id, strlen(coalesce(text, '')) as n, hex(encode(coalesce(text, ''))) as h from documents),
    pieces as (
      select r, c, substring(h, 2 * c + 1, 898) as h
      from (select r, h, unnest(range(0, n - 199, 250)) as c from d where n >= 200)),
    w as (
      select r, c + i as p, md5(substring(h, 2 * i + 1, 400)) as k
      from (select r, c, h, unnest(range(length(h) // 2 - 199)) as i from pieces)),
    repeated as (
      select r, p, p > coalesce(lag(p) over (partition by r order by p), -1000) + 200 as opens
      from w where k in (select k from w group by k having count(*) > 1)),
    spans as (
      select r, min(p) as b, max(p) + 200 as e
      from (select r, p, sum(opens::int) over (partition by r order by p) as s from repeated) group by r, s),
    gaps as (
      select r, b, e, coalesce(lag(e) over (partition by r order by b), 0) as after from spans),
    kept as (
      select d.r, sum(e - b) as n_removed, count(*) as n_spans,
        string_agg(substring(h, 2 * after + 1, 2 * (b - after)), '' order by b) || substring(any_value(h), 2 * max(e) + 1) as h
      from gaps join d using (r) group by d.r)
    select doc_id, n as n_bytes, coalesce(n_removed, 0)::bigint as n_removed, coalesce(n_spans, 0) as n_spans,
      sha256(unhex(coalesce(kept.h, d.h))) as kept_sha256
    from d left join kept using (r)""")
def _suffixes(spark, sf_dir):
    cut = suffixes.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["begin"])
    return cut.select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_contracted_trie", """
    with turns as (
      select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
        row_number() over (partition by conv_id order by turn nulls first, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 as i
      from conversations where conv_id is not null),
    sizes as (
      select c, count(*) as n, c - c % 5 as b,
        xor(list_reduce(
          [4294967295::bigint] || flatten(list_transform(string_split(c::varchar, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
          lambda crc, x: case when x >= 0 then xor(crc, x) else xor(crc >> 1, 3988292384::bigint * (crc & 1)) end), 4294967295::bigint) % 9 as h
      from turns group by c),
    whole as (select s.*, least(s.h, coalesce(o.n, 0)) as m from sizes s left join sizes o on o.c = s.b),
    built as (
      select w.c, t.i as pos, t.role, t.text from whole w join turns t on t.c = w.b and t.i < w.h
      union all
      select w.c, t.i - w.h + w.m, t.role, t.text from whole w join turns t on t.c = w.c and t.i >= w.h),
    paths as (
      select c, pos + 1 as depth, strlen(text) as n_bytes,
        md5(string_agg(md5(strlen(role) || ':' || role || text), '' order by pos) over (partition by c order by pos)) as k
      from built
      union all select c, 0, 0, 'root' from whole),
    steps as (
      select *, lag(k) over (partition by c order by depth) as p, lead(k) over (partition by c order by depth) is null as is_last from paths),
    nodes as (
      select k, any_value(p) as p, depth, min(c) as conv_id, count(*) as n_convs, (count(*) - 1) * any_value(n_bytes) as saved,
        coalesce(string_agg(case when is_last then c::varchar end, ',' order by c), '') as ends
      from steps group by k, depth),
    children as (select p as k, count(*) as n_children from nodes where p is not null group by p),
    totals as (
      select a.k, sum(n.saved) as saved_tokens, count(*) filter (where n.k not in (select k from children)) as n_leaves
      from nodes n join paths a on a.c = n.conv_id and a.depth <= n.depth group by a.k)
    select n.conv_id, n.depth, o.conv_id as parent_conv_id, n.n_convs, coalesce(c.n_children, 0) as n_children, t.n_leaves,
      t.saved_tokens::bigint as saved_tokens, sha256(n.ends) as ends_sha256
    from nodes n join totals t using (k) left join children c using (k) left join nodes o on o.k = n.p""")
def _trie(spark, sf_dir):
    return trie.prefix_trie(table(spark, sf_dir, "conversations"))


@query("op13_token_alignment")
def _alignment(spark, sf_dir):
    return alignment.alignment(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))
