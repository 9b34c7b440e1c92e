"""Registered queries of the training-data operators: ``QUERIES`` and, where SQL can express one, ``ORACLE_SQL``.

Every query reads its whole table; the digest columns are derived here, the operators keep their own outputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from encore.llm import context_trees, disclosure, maxscore, piece_viterbi, preference, raking, slots, token_edits, turn_repair, zone_negatives
from encore.llm.compression import compression_report
from encore.llm.multiorder_join import near_duplicates
from encore.llm.secret_cnn import KINDS, scan_secrets, span_digest, train
from encore.llm.textops import bounded_batches
from encore.session import ensure_session, scratch_path
from encore.sources.tables import read_table

#: Production parameters.
N_SHARDS = 24
BYTE_RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MIX = raking.MixTargets(
    source={f"src{i}": 0.05 for i in range(20)},
    lang={"en": 0.52, "de": 0.16, "fr": 0.16, "es": 0.16},
    topic={"prose": 0.85, "list": 0.06, "table": 0.05, "markup": 0.04})

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        def build(spark: SparkSession, sf_dir: str) -> DataFrame:
            bounded_batches(spark)
            return fn(ensure_session(spark), sf_dir)
        build.__name__, build.__doc__ = name, fn.__doc__
        QUERIES[name] = build
        if sql:
            ORACLE_SQL[name] = sql
        return fn
    return register


@_query("op1_preference_pairs", """
with c as (select conv_id as pair_id, turn, coalesce(role, 'unknown') as role, coalesce(text, '') as text, role as raw_role
           from conversations where conv_id is not null),
last as (select pair_id, max(turn) as at from c where raw_role = 'assistant' group by 1),
answer as (select c.pair_id, l.at, max(c.text) as text from c join last l on c.pair_id = l.pair_id and c.turn = l.at
           where c.raw_role = 'assistant' group by 1, 2),
sides as (
  select distinct c.pair_id, 'chosen' as side, c.turn, c.role, c.text from c join last using (pair_id)
  union all select distinct c.pair_id, 'rejected', c.turn, c.role, c.text from c join last using (pair_id) where c.turn < last.at
  union all select l.pair_id, 'rejected', l.at, 'assistant', o.text from last l join answer o on o.pair_id = l.pair_id + 1),
numbered as (select *, row_number() over (partition by pair_id, side order by turn, role, text) as rn,
                    '<|' || role || '|>' || chr(10) as head from sides),
both_sides as (
  select coalesce(a.pair_id, b.pair_id) as pair_id, coalesce(a.rn, b.rn) as rn,
         coalesce(a.role = b.role and a.text = b.text, false) as same
  from (select * from numbered where side = 'chosen') a full join (select * from numbered where side = 'rejected') b
    on a.pair_id = b.pair_id and a.rn = b.rn),
prefix as (select pair_id, cast(coalesce(min(case when not same then rn end) - 1, max(rn)) as integer) as n from both_sides group by 1),
placed as (
  select t.*, p.n, head || text || '<|end|>' || chr(10) as shown,
         sum(length(head) + length(text) + 8) over (partition by t.pair_id, side, rn > n order by rn) - length(text) - 8 as start
  from numbered t join prefix p using (pair_id)),
done as (
  select pair_id, any_value(n) as n_prompt_turns,
    cast(count(*) filter (side = 'chosen' and rn > n) as integer) as n_chosen_turns,
    cast(count(*) filter (side = 'rejected' and rn > n) as integer) as n_rejected_turns,
    count(*) filter (side = 'rejected') as all_rejected,
    coalesce(string_agg(shown, '' order by rn) filter (side = 'chosen' and rn <= n), '') as prompt,
    coalesce(string_agg(shown, '' order by rn) filter (side = 'chosen' and rn > n), '') as chosen,
    coalesce(string_agg(shown, '' order by rn) filter (side = 'rejected' and rn > n), '') as rejected,
    coalesce(string_agg(start || ':' || (start + length(text)), ',' order by rn)
      filter (side = 'chosen' and rn > n and role = 'assistant' and text <> ''), '') as chosen_spans,
    coalesce(string_agg(start || ':' || (start + length(text)), ',' order by rn)
      filter (side = 'rejected' and rn > n and role = 'assistant' and text <> ''), '') as rejected_spans
  from placed group by 1)
select pair_id, n_prompt_turns, n_chosen_turns, n_rejected_turns,
  case when all_rejected = 0 then 'missing_rejected' when n_chosen_turns = 0 and n_rejected_turns = 0 then 'identical'
       when n_chosen_turns = 0 then 'chosen_ends' when n_rejected_turns = 0 then 'rejected_ends' else 'pair' end as status,
  prompt, chosen, rejected, chosen_spans, rejected_spans
from done
""")
def _op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation against itself with the next one's last answer: prompt once, two masked completions."""
    turns = preference.swapped_answers(read_table(spark, sf_dir, "conversations"))
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return preference.preference_examples(turns).withColumns({c: text(F.col(c)) for c in ("chosen_spans", "rejected_spans")})


@_query("op2_compression_bands")
def _op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the compression-band verdict of every document."""
    return compression_report(read_table(spark, sf_dir, "documents"))


@_query("op3_edit_aware_counts")
def _op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document, before and after three edits drawn from its own text."""
    import public_tokenizers

    docs = read_table(spark, sf_dir, "documents").withColumn("edits", token_edits.drawn_edits())
    ranks = token_edits.read_ranks(spark.conf.get("encore.llm.byte_ranks", BYTE_RANKS), public_tokenizers.PATTERN)
    return token_edits.count_edited(docs, ranks)


@_query("op4_maxscore_top_k", """
with v as (select vec_id, min(list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint))) as v from embeddings
           where vec_id is not null and len(embedding) > 0
             and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 group by 1),
pairs as (select q.vec_id as query_id, c.vec_id,
                 cast(list_dot_product(cast(q.v as double[]), cast(c.v as double[])) as bigint) as score
          from v q join v c on q.vec_id % 100 = 0 and c.vec_id <> q.vec_id),
ranked as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from pairs)
select query_id, rank, vec_id, score from ranked where rank <= 10
""")
def _op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector over all vectors."""
    vectors = maxscore.integer_vectors(read_table(spark, sf_dir, "embeddings")).checkpoint()
    return maxscore.top_k(vectors.where("vec_id % 100 = 0"), vectors, 10)


@_query("op5_virtual_slots")
def _op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards near equal in bytes, by a stored slot map that is rebalanced once."""
    rows = slots.with_slots(read_table(spark, sf_dir, "documents"))
    weights, path = slots.slot_bytes(rows).checkpoint(), scratch_path(spark, "slot-map")
    slots.store_map(slots.initial_map(spark, N_SHARDS), path)
    slots.store_map(slots.rebalance(slots.load_map(spark, path), weights, N_SHARDS), path)
    placed = slots.place(rows, slots.load_map(spark, path).select("virtual_slot", "shard"), weights)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


@_query("op6_disclosure")
def _op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document, and the terms around it that give it away."""
    found = disclosure.find_personal_data(read_table(spark, sf_dir, "documents"))
    of = lambda k: F.size(F.filter("base", lambda s: s["rank"] == k)).cast("long")
    return found.select("doc_id", *(of(k).alias(f"n_{kind}") for k, kind in enumerate(disclosure.KINDS)),
                        F.sha2(disclosure.span_text(F.col("base")), 256).alias("base_sha256"),
                        disclosure.span_text(disclosure.all_spans(F.col("base"), F.col("terms"))).alias("spans"),
                        F.size("terms").cast("long").alias("n_term"))


@_query("op7_multiorder_jaccard")
def _op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return near_duplicates(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@_query("op8_piece_viterbi")
def _op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every document (count and checksum), and whether decoding them gives the text back."""
    vocabulary = piece_viterbi.read_vocabulary(piece_viterbi.model_path(spark))
    return piece_viterbi.token_report(read_table(spark, sf_dir, "documents"), vocabulary)


@_query("op9_raked_mixture")
def _op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's cell, calibrated probability and whether the mixture samples it."""
    docs = raking.with_topics(read_table(spark, sf_dir, "documents"))
    return raking.mix(docs, MIX).select("doc_id", "cell_source", "cell_lang", "cell_topic", "n_tokens", "probability", "sampled")


@_query("op10_secret_scan")
def _op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: rule findings and what the character network adds."""
    docs = read_table(spark, sf_dir, "documents")
    found = scan_secrets(docs, train(docs))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(span_digest(F.col("spans"), KINDS[:3]), 256).alias("base_sha256"),
                        span_digest(F.col("spans")).alias("spans"), "n_cnn")


@_query("op11_zone_negatives", """
with fine as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                     list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
              where vec_id is not null and label is not null and len(embedding) > 0
                and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
v as (select * from fine qualify row_number() over (partition by vec_id order by label, v) = 1),
s as (select a.vec_id as anchor_id, c.vec_id, a.label = c.label as same,
             cast(list_dot_product(cast(a.v as double[]), cast(c.v as double[])) as bigint) as score
      from v a join v c on a.vec_id % 100 = 0 and c.vec_id <> a.vec_id),
p as (select anchor_id, vec_id as positive_id, score as positive_score from s where same
      qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
n as (select p.*, s.vec_id as negative_id, s.score as negative_score,
             cast(row_number() over (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id) as integer) as rank
      from p join s on p.anchor_id = s.anchor_id and not s.same and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
""")
def _op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten hard negatives for each of the five best positives of every hundredth vector, over all vectors."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = zone_negatives.integer_rows(read_table(spark, sf_dir, "embeddings"), label=label).checkpoint()
    return zone_negatives.mine(vectors, vectors.where("vec_id % 100 = 0"))


@_query("op12_context_trees")
def _op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code length of every document under context trees, and its word score, learned from four fifths of all documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = context_trees.train(docs.where(~context_trees.is_held_out()))
    return context_trees.score(docs, model).select(
        "doc_id", context_trees.is_held_out().alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score", "score", "n_bytes", "bits_per_byte")


@_query("op13_turn_repair")
def _op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and repaired digest of every conversation after damage."""
    turns = read_table(spark, sf_dir, "conversations")
    return turn_repair.audits(turn_repair.damaged(turns), turns)
