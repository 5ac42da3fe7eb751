"""The registered queries of the operators and their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bazaarlake.llm import (
    bpe, chat, fingerprint, jaccard, lines, mixing, negatives, neighbours, packing, pii, quality, resampling, sharding
)
from bazaarlake.llm.common import read


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = pii.find_pii(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select(
        "row.doc_id", "result.n_email", "result.n_ip", "result.n_card", "result.n_phone",
        F.sha2("result.base", 256).alias("base_sha256"), "result.spans", "result.n_spans",
    )


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op3_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    placed = sharding.into_shards(docs)
    return placed.select(
        "row.doc_id", (F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("long") + 16).alias("size"),
        F.crc32(F.coalesce("row.text", F.lit(""))).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.components(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = lines.drop_repeated_lines(docs)
    return out.select("row.doc_id", "result.n_lines", "result.n_dropped", F.sha2("result.kept", 256).alias("kept_sha256"))


OP6_SQL = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as nr
  from documents),
keyed as (
  select *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines),
repeated as (
  select key, max(doc_id) as keeper from keyed where length(key) >= 20
  group by key having count(distinct doc_id) >= 3),
marked as (
  select doc_id, nr, line, keeper is not null and keeper <> doc_id as gone
  from keyed left join repeated using (key))
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by nr) filter (where not gone), '')) as kept_sha256
from marked group by doc_id
"""


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    given = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.format_conversations(given.unionByName(own)).select(
        "conv_id", F.length("formatted").cast("long").alias("formatted_chars"), chat.parse(F.col("formatted")).alias("turns")
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = chat.under_loss(F.col("turns"))
    return out.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars",
    )


OP7_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
  union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(role) + length(text) + 20 + case when regexp_matches(role || chr(10) || text,
      '<s>|<s\|e>|\[INST\]|\[/INST\]|</s>') then 2 + length(regexp_replace(role || text, '[^\\<\[]', '', 'g')) else 0 end as chars
  from rows)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
       coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
       sum(chars)::bigint as formatted_chars
from sized group by conv_id
"""


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.schedule(mixing.measure(read(spark, sf_dir, "documents")), measured=("size", "digest"))
    return plan.select("row.doc_id", "size", "source_size", "target", "taken")


OP8_SQL = r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, '')), 1, 15))::bigint as place
  from documents),
by_source as (select source, sum(size)::bigint as words from sized group by source),
weighed as (
  select *, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight from by_source),
filled as (
  select *, (sum(words) over () * 1.5::double - coalesce(sum(2 * words) over (
             order by 2 * words / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
            / sum(weight) over (order by 2 * words / weight, source nulls last rows between current row and unbounded following) as level
  from weighed),
targets as (
  select source, words, sum(words) over () as total, row_number() over (order by source nulls last) as nr,
         coalesce(least((2 * words)::double, max(level) filter (where level * weight <= 2 * words) over () * weight), (2 * words)::double) as target
  from filled),
dealt as (
  select s.doc_id, s.size, t.words, t.total, t.target, t.nr,
         sum(s.size) over (partition by s.source order by s.place, s.doc_id rows unbounded preceding) as done
  from sized s join targets t on s.source is not distinct from t.source),
timed as (
  select doc_id, size, words, total, target, nr, round * words + done as dealt,
         case when target > 0 and size > 0 then (round * words + done)::double / target end as finish
  from dealt, (values (0), (1)) as rounds(round)),
spent as (
  select *, case when finish is not null then sum(size) over (order by finish nulls last, nr, dealt rows unbounded preceding) end as spent
  from timed)
select doc_id, any_value(size) as size, any_value(words) as source_size, any_value(target) as target,
       coalesce(sum(size) filter (where spent <= total * 1.5), 0)::bigint as taken
from spent group by doc_id
"""

def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels")
    return quality.score(docs, labels).select("row.doc_id", "held_out", "score", "predicted")


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_edits(read(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    out = resampling.resample(docs.select("doc_id", "text"), target.select("text"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(negatives.relabelled(read(spark, sf_dir, "embeddings")))


OP13_SQL = r"""
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as q
  from embeddings
  where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as anchor_id, b.vec_id, a.label = b.label as same, list_inner_product(a.q, b.q)::bigint as score
  from rows a join rows b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, p.positive_id,
       row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id)::int as rank,
       s.vec_id as negative_id, p.positive_score, s.score as negative_score
from positives p join scored s on s.anchor_id = p.anchor_id and not s.same
 and 80 * p.positive_score <= 100 * s.score and 100 * s.score <= 100 * p.positive_score
qualify rank <= 5
"""


QUERIES = {
    f.__name__: f
    for f in (
        op1_pii, op2_neighbours, op3_shuffle, op4_bpe, op5_jaccard, op6_lines, op7_chat, op8_mix, op9_quality, op10_fingerprint,
        op11_pack, op12_resample, op13_negatives,
    )
}
SQL = {"op6_lines": OP6_SQL, "op7_chat": OP7_SQL, "op8_mix": OP8_SQL, "op13_negatives": OP13_SQL}
