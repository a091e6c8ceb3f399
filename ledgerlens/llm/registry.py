"""The operators as queries over the driver tables, and their DuckDB texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloomlm, decontam, differencing, fixity, langid, lines, negatives, packing, prefix_trie, quality, secret_scan, setsketch, vectors
from .staging import keep


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words found in every whole document."""
    return decontam.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLE_OP1 = r"""
with d as (
  select row_number() over () rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from documents),
b as (
  select cast(item_id as varchar) item,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
  from benchmark),
win as (
  select distinct item, size, array_to_string(w[i:i + size - 1], ' ') gram
  from (select item, w, least(10, len(w)) size, unnest(range(1, len(w) - least(10, len(w)) + 2)) i from b where len(w) > 0)),
slid as (
  select rid, size, i, array_to_string(w[i:i + size - 1], ' ') gram
  from (select rid, w, size, unnest(range(1, len(w) - size + 2)) i
        from d, (select distinct size from win) where len(w) >= size)),
hit as (select s.rid, s.i, s.size, win.item from slid s join win using (gram, size)),
hw as (select rid, count(distinct p) n_hit from (select rid, unnest(range(i, i + size)) p from hit) group by rid),
it as (select rid, count(*) n_items, string_agg(item, ',' order by item) items
       from (select distinct rid, item from hit where item is not null) group by rid)
select doc_id, cast(len(w) as bigint) n_words, cast(coalesce(n_hit, 0) as bigint) n_hit,
  cast(coalesce(n_items, 0) as bigint) n_items, sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join hw using (rid) left join it using (rid)
"""

def op6_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as WARC archives, audited against a replica with known damage.

    The replica is the archive as a faulty disk would return it, by a rule on
    the record's hash: of 256 records one has its last byte changed, one is cut
    in half and one is missing.
    """
    written = fixity.warc_records(_table(spark, sf_dir, "pages"))
    hashed = written.withColumn("hash", F.sha2("record", 256)).withColumn("size", F.octet_length("record").cast("bigint"))
    fault = F.substring("hash", 1, 2)
    damaged = F.when(fault == "00", F.concat(F.expr("left(record, length(record) - 1)"), F.lit("#"))).when(fault == "01", F.expr("left(record, length(record) div 2)")).otherwise(F.col("record"))
    hashed = hashed.withColumn("replica_hash", F.when(fault != "02", F.sha2(damaged, 256))).drop("record")
    placed = keep(fixity.laid_out(hashed), "archives")
    replica = placed.where("replica_hash is not null").select("archive", "offset", F.col("replica_hash").alias("hash"))
    return fixity.report(placed, replica)


ORACLE_OP6 = r"""
with r as (
  select page_id, url, 'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || coalesce(cast(page_id as varchar), '')
    || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
    || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) record
  from pages),
h as (select page_id, url, record, sha256(record) hash, strlen(record) size from r),
p as (
  select *, (row_number() over (order by page_id nulls first, url nulls first, hash) - 1) rk,
    case left(hash, 2) when '00' then sha256(left(record, length(record) - 1) || '#') when '01' then sha256(left(record, length(record) // 2)) when '02' then null else hash end rhash
  from h),
o as (
  select rk // 1024 archive, hash, rhash, size,
    coalesce(sum(size) over (partition by rk // 1024 order by rk rows between unbounded preceding and 1 preceding), 0)::bigint "offset" from p),
e as (select 1 side, archive, "offset", hash from o union all select 2, archive, "offset", rhash from o where rhash is not null),
n0 as (select side, archive, "offset" >> 16 node, sha256(string_agg("offset" || ':' || hash, ',' order by "offset")) hash from e group by all),
n1 as (select side, archive, node >> 4 up, sha256(string_agg(node || ':' || hash, ',' order by node)) hash from n0 group by all),
n2 as (select side, archive, up >> 4 node, sha256(string_agg(up || ':' || hash, ',' order by up)) hash from n1 group by all),
n3 as (select side, archive, node >> 4 up, sha256(string_agg(node || ':' || hash, ',' order by node)) hash from n2 group by all),
n4 as (select side, archive, up >> 4 node, sha256(string_agg(up || ':' || hash, ',' order by up)) hash from n3 group by all),
n as (select *, 0 level from n0 union all select *, 1 from n1 union all select *, 2 from n2 union all select *, 3 from n3 union all select *, 4 from n4),
c as (
  select archive, level, node, max(hash) filter (side = 1) ours, max(hash) filter (side = 2) theirs,
    max(hash) filter (side = 1) is distinct from max(hash) filter (side = 2) bad
  from n group by all),
seen as (
  -- a node is looked at if it is the root or its parent differs
  select c.archive, count(*) n_compared from c left join c u on u.archive = c.archive and u.level = c.level + 1 and u.node = c.node >> 4
  where c.level = 4 or u.bad group by all),
b as (
  select archive, count(*) n_bad, string_agg("offset" || ':' || case when rhash is null then 'missing' else 'changed' end, ',' order by "offset") bad
  from o where rhash is distinct from hash group by all),
s as (select archive, count(*) n_records, sum(size)::bigint n_bytes from o group by all)
select s.archive::bigint archive, n_records, n_bytes, ours root, theirs replica_root, not c.bad intact, n_compared, coalesce(n_bad, 0)::bigint n_bad, coalesce(b.bad, '') bad
from s join c on c.archive = s.archive and c.level = 4 join seen on seen.archive = s.archive left join b on b.archive = s.archive
"""


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-equal lines of all documents, one occurrence of each group kept."""
    return lines.report(_table(spark, sf_dir, "documents"))


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 4096 tokens, by best-fit decreasing."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path())


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keyed secrets and random strings in every whole document."""
    return secret_scan.report(_table(spark, sf_dir, "documents"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets are similar by 0.75 or more."""
    return setsketch.report(_table(spark, sf_dir, "documents"))


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all embeddings with a cosine of 0.95 or more."""
    return vectors.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole document by votes of its nearest labelled documents."""
    return quality.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every whole document under unigrams and a Bloom-filter bigram model."""
    return bloomlm.report(_table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole document by naive Bayes over hashed character n-grams."""
    return langid.report(_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every vector whose vec_id is divisible by 100, among all vectors."""
    return negatives.report(_table(spark, sf_dir, "embeddings"))


ORACLE_OP11 = r"""
with v as (
  select row_number() over () rid, vec_id::bigint vec_id, (case when vec_id % 7 = 0 then (label + 1) % 10 else label end)::bigint label,
    list_transform(embedding, lambda x: floor(256 * x::double)) q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.rid anchor, a.vec_id anchor_id, b.rid, b.vec_id, a.label = b.label same, list_dot_product(a.q, b.q)::bigint score
  from v a join v b on a.rid <> b.rid where a.vec_id % 100 = 0),
pos as (select anchor, anchor_id, vec_id positive_id, score positive_score, row_number() over (partition by anchor order by score desc, vec_id, rid) place from s where same qualify place <= 5)
select pos.anchor_id, positive_id, row_number() over (partition by pos.anchor, place order by score desc, vec_id, rid) rank, vec_id negative_id, positive_score, score negative_score
from pos join s on s.anchor = pos.anchor and not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
qualify rank <= 10
"""


def op12_differencing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens, by Karmarkar-Karp differencing."""
    return differencing.pack(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations with its rollups."""
    return prefix_trie.report(_table(spark, sf_dir, "conversations"))


ORACLE_OP13 = r"""
with t as (
  select conv_id::bigint conv_id, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), sha256(coalesce(text, ''))) place,
    length(coalesce(text, '')) n_chars, sha256(coalesce(role, '')) || sha256(coalesce(text, '')) turn_key
  from conversations where conv_id is not null),
-- crc32 of the decimal id, bit by bit
n as (
  select conv_id, count(*) n, conv_id - conv_id % 100 base,
    xor(list_reduce([4294967295::bigint] || flatten(list_transform(string_split(conv_id::varchar, ''), lambda ch: [ascii(ch)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
      lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end), 4294967295) % 6 h
  from t group by conv_id),
s as (select n.conv_id, n.base, n.h, least(n.h, coalesce(b.n, 0)) head, least(n.h, coalesce(b.n, 0)) + greatest(n.n - n.h, 0) len from n left join n b on b.conv_id = n.base),
r as (
  select s.conv_id, place, n_chars, turn_key from s join t on t.conv_id = s.base where place <= head
  union all select s.conv_id, place - h + head, n_chars, turn_key from s join t using (conv_id) where place > h),
p as (
  select conv_id, place depth, n_chars, string_agg(turn_key, ',') over (partition by conv_id order by place rows unbounded preceding) prefix from r
  union all select conv_id, 0, 0, '' from s),
node as (
  select depth, prefix, min(p.conv_id) conv_id, count(*) n_convs, max(n_chars) n_chars,
    sha256(coalesce(string_agg(p.conv_id, ',' order by p.conv_id) filter (depth = len), '')) ends_sha256
  from p join s using (conv_id) group by depth, prefix),
up as (
  select v.depth, v.prefix, u.prefix parent, u.conv_id parent_conv_id
  from node v join p on p.conv_id = v.conv_id and p.depth = v.depth - 1 join node u on u.depth = p.depth and u.prefix = p.prefix),
child as (select depth - 1 depth, parent prefix, count(*) n_children from up group by all),
own as (select node.*, coalesce(n_children, 0) n_children, (n_convs - 1) * n_chars saved from node left join child using (depth, prefix)),
total as (
  select p.depth, p.prefix, sum((n_children = 0)::bigint) n_leaves, sum(saved) saved_tokens
  from own v join p on p.conv_id = v.conv_id and p.depth <= v.depth group by all)
select own.conv_id, own.depth::bigint depth, parent_conv_id, n_convs, n_children::bigint n_children, n_leaves::bigint n_leaves, saved_tokens::bigint saved_tokens, ends_sha256
from own join total using (depth, prefix) left join up using (depth, prefix)
"""


_QUERIES: dict[str, tuple[Callable, str | None]] = {
    "op1_decontamination": (op1_decontamination, ORACLE_OP1),
    "op2_secrets": (op2_secrets, None),
    "op3_near_duplicates": (op3_near_duplicates, None),
    "op4_embeddings": (op4_embeddings, None),
    "op5_quality": (op5_quality, None),
    "op6_fixity": (op6_fixity, ORACLE_OP6),
    "op7_lines": (op7_lines, None),
    "op8_packing": (op8_packing, None),
    "op9_language_model": (op9_language_model, None),
    "op10_language": (op10_language, None),
    "op11_hard_negatives": (op11_hard_negatives, ORACLE_OP11),
    "op12_differencing": (op12_differencing, None),
    "op13_prefix_trie": (op13_prefix_trie, ORACLE_OP13),
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: fn for name, (fn, _) in _QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name, (_, sql) in _QUERIES.items() if sql}
