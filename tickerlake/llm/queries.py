"""One registered query per operator, over its whole table, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ann import nearest
from .codes import vector_codes
from .common import fold, table
from .decontaminate import find_leaks
from .fingerprints import edited_fingerprints
from .langid import fit_languages, predict_languages
from .lm import score_documents
from .manifest import manifest, without_line_feeds
from .mixing import mix_sources
from .neardup import near_duplicates
from .packing import pack_documents
from .quality import resample
from .suffix_dedup import remove_repeats
from .toxicity import learn_lexicon, score_toxicity, train_rows


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lexicon = learn_lexicon(docs, train_rows(table(spark, sf_dir, "labels")))
    return score_toxicity(docs, lexicon).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted", "weight", "terms"
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = remove_repeats(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).drop("set_key")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit_languages(docs.where(fold(F.col("doc_id")) != 0).select("text", "lang"))
    return predict_languages(docs, model).select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "lang_pred", "score"
    )


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = edited_fingerprints(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        "fingerprint", "edited_fingerprint", "near_edited", "near_next",
    )


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = train_rows(table(spark, sf_dir, "labels")).where(F.col("quality").isNotNull())
    good = labels.where(F.col("quality") == 1)
    counted = labels.agg(F.count("*").alias("n"), F.sum("quality").alias("good")).first()
    share = counted["good"] / counted["n"] if counted["n"] else 1.0
    rows = resample(table(spark, sf_dir, "documents"), good.select("doc_id"), keep_share=share)
    return rows.select(
        "doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "n_features", "log_weight", "score", "gumbel_key", "selected"
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target",
        (F.col("copies") * F.col("size")).alias("taken"), "copies",
    )


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), held_out=1).withColumn("held_out", fold(F.col("doc_id")) == 1)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(table(spark, sf_dir, "documents"), without_line_feeds()).select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


OP9_SQL = """
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         ((('0x' || substr(md5('mix/' || doc_id::varchar), 1, 12))::bigint)::double + 0.5) / 281474976710656.0 as u
  from documents
), totals as (
  select source, sum(size)::bigint as source_size from sized group by source
), placed as (
  select source, source_size,
         case (row_number() over (order by source asc nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight,
         (2 * source_size)::double as cap, (sum(source_size) over ())::double * 1.5 as budget
  from totals
), leveled as (
  select *, (budget - coalesce(sum(cap) over (order by cap / weight, source asc nulls last rows between unbounded preceding and 1 preceding), 0))
          / sum(weight) over (order by cap / weight, source asc nulls last rows between current row and unbounded following) as common
  from placed
), targets as (
  select source, source_size, case when cap / weight <= common then cap
         else weight * (select arg_min(common, cap / weight) from leveled where cap / weight > common) end as target
  from leveled
), plan as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as whole,
         case when source_size > 0 then target / source_size else 0 end as ratio
  from targets
), keyed as (
  select *, case when size > 0 then (u / (1 - u)) * (((sum(size) over (partition by source))::double / count(*) over (partition by source)) / size) end as key
  from sized
), ranked as (
  select d.doc_id, d.size, p.source_size, p.target, p.whole, case when d.size > 0 then p.target - p.whole * p.source_size else 0 end as left_over,
         coalesce(sum(d.size) over (partition by d.source order by d.key nulls last, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as before
  from keyed d join plan p on d.source is not distinct from p.source
)
select doc_id, size, source_size, target,
       ((whole + case when left_over > 0 and before + size / 2 <= left_over then 1 else 0 end) * size)::bigint as taken,
       (whole + case when left_over > 0 and before + size / 2 <= left_over then 1 else 0 end)::int as copies
from ranked
"""

OP2_SQL = """
with bytes as (
  select doc_id, regexp_extract_all(hex(encode(coalesce(text, ''))), '..') as h from documents
), single as (
  select doc_id, unnest(range(0, len(h))) as i, unnest(h) as byte from bytes
), places as (
  select doc_id, i, byte, case when count(*) over w = 50 then string_agg(byte, '') over w end as string
  from single window w as (partition by doc_id order by i rows between current row and 49 following)
), firsts as (
  select string, min(doc_id) as first from places where string is not null group by string having min(doc_id) < max(doc_id)
), marked as (
  select p.doc_id, p.i, p.byte, coalesce(p.doc_id > f.first, false) as starts from places p left join firsts f on p.string = f.string
), covered as (
  select doc_id, i, byte, bool_or(starts) over (partition by doc_id order by i rows between 49 preceding and current row) as gone
  from marked
), runs as (
  select *, gone and not coalesce(lag(gone) over (partition by doc_id order by i), false) as opens from covered
), kept as (
  select doc_id, count(*) as n_bytes, count(*) filter (where gone) as n_removed, count(*) filter (where opens) as n_spans,
         coalesce(string_agg(byte, '' order by i) filter (where not gone), '') as rest
  from runs group by doc_id
)
select b.doc_id, coalesce(n_bytes, 0)::bigint as n_bytes, coalesce(n_removed, 0)::bigint as n_removed,
       coalesce(n_spans, 0)::bigint as n_spans, sha256(unhex(coalesce(rest, ''))) as kept_sha256
from bytes b left join kept k on b.doc_id = k.doc_id
"""

OP3_SQL = """
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w
  from documents
), shingles as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s
  from words, unnest(range(1, greatest(len(w) - 3, 1) + 1)) as t(i) where len(w) > 0
), sizes as (
  select doc_id, count(*) as n from shingles group by doc_id
), shared as (
  select a.doc_id as a, b.doc_id as b, count(*) as common
  from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all
), links as (
  select a, b from shared join sizes x on a = x.doc_id join sizes y on b = y.doc_id where 100 * common >= 80 * (x.n + y.n - common)
), reached as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reached r join links l on r.b = l.a
)
select r.a as doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(r.b) as component_id, r.a = min(r.b) as kept
from reached r left join sizes s on r.a = s.doc_id group by r.a
"""

OP12_SQL = """
with item_words as (
  select coalesce(item_id::varchar, '') as item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from benchmark
), windows as (
  select distinct item, least(len(w), 10) as n, array_to_string(w[i:i + 9], ' ') as s
  from item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as t(i) where len(w) > 0
), words as (
  select doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
  from documents
), places as (
  select doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') as s
  from words, (select distinct n from windows) as sizes, unnest(range(1, len(w) - n + 2)) as t(i)
), hits as (
  select p.doc_id, p.i, p.n, v.item from places p join windows v on p.n = v.n and p.s = v.s
), hit_words as (
  select doc_id, count(distinct place) as n_hit from (select doc_id, unnest(range(i, i + n)) as place from hits) group by doc_id
), hit_items as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from hits) group by doc_id
)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words w left join hit_words h on w.doc_id = h.doc_id left join hit_items i on w.doc_id = i.doc_id
"""


def _lloyd_sql(rounds: int = 2) -> str:
    """Codebooks c0, c1, ... (p, e, v) and the parts' entries a0, a1, ... by the codebook of the same number."""
    def assigned(r: int) -> str:
        return f"""a{r} as materialized (
  select rid, p, arg_min(e, d * 64 + e) as e, min(d) as d
  from (select x.rid, x.p, c.e, list_sum(list_transform(range(1, len(x.v) + 1), lambda i: (x.v[i] - c.v[i]) * (x.v[i] - c.v[i])))::bigint as d
        from parts x join c{r} c on x.p = c.p)
  group by rid, p
)"""

    def means(r: int) -> str:
        return f"""c{r + 1} as materialized (
  select c.p, c.e, coalesce(m.v, c.v) as v from c{r} c left join (
    select p, e, list((s - ((s % n) + n) % n) // n order by i) as v
    from (select p, e, i, sum(x)::bigint as s, count(*) as n
          from (select a.p, a.e, unnest(x.v) as x, unnest(range(1, len(x.v) + 1)) as i from a{r} a join parts x on a.rid = x.rid and a.p = x.p)
          group by p, e, i)
    group by p, e
  ) m on c.p = m.p and c.e = m.e
)"""

    steps = ", ".join(f"{assigned(r)}, {means(r)}" for r in range(rounds)) + ", " + assigned(rounds)
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id, embedding) - 1 as rid, vec_id, label,
         list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as w
  from embeddings where embedding is not null and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
), parts as materialized (
  select rid, p, w[p * (len(w) // 16) + 1 : (p + 1) * (len(w) // 16)] as v from kept, unnest(range(16)) as t(p)
), c0 as materialized (
  select p, rid as e, v from parts where rid < 64
), {steps}, named as (
  select k.vec_id, k.label, a.code, a.error
  from kept k join (select rid, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by p) as code, sum(d)::bigint as error from a{rounds} group by rid) a on k.rid = a.rid
)
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error,
       (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) from c{rounds}) as codebooks_sha256
from named
"""


def _merkle_sql(depth: int = 12, forest_depth: int = 3) -> str:
    """Levels one by one: ``depth`` for a source's documents, ``forest_depth`` for the sources.

    A level has (tree, lo, n, digest): n nodes a tree; a root stays as it is.
    A leaf's fold takes what its run has before and after it on each level.
    """
    def levels(name: str, first: str, count: int) -> str:
        out = f"{name}0 as materialized ({first})"
        for k in range(count):
            out += f""", {name}{k + 1} as materialized (
  select tree, lo // 3 as lo, (max(n) + 2) // 3 as n,
         case when max(n) > 1 then sha256(string_agg(digest, '' order by lo)) else min(digest) end as digest
  from {name}{k} group by tree, lo // 3
)"""
        return out

    def folds(name: str, nodes: str, first: str, count: int) -> str:
        out = f"{name}0 as materialized ({first})"
        for k in range(count):
            out += f""", {name}{k + 1} as materialized (
  select f.* exclude (fold, proof, lo), f.lo // 3 as lo, f.proof || s.before || s.after as proof,
         case when s.many then sha256(s.before || f.fold || s.after) else f.fold end as fold
  from {name}{k} f join (
    select a.tree, a.lo, any_value(a.n) > 1 as many,
           coalesce(string_agg(b.digest, '' order by b.lo) filter (where b.lo < a.lo), '') as before,
           coalesce(string_agg(b.digest, '' order by b.lo) filter (where b.lo > a.lo), '') as after
    from {nodes}{k} a join {nodes}{k} b on a.tree = b.tree and a.lo // 3 = b.lo // 3 group by a.tree, a.lo
  ) s on f.{{key}} = s.tree and f.lo = s.lo
)"""
        return out

    def field(column: str) -> str:
        return f"coalesce(strlen({column}::varchar)::varchar || ':' || {column}::varchar, '-')"

    head = " || ".join(field(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = """list_reduce(list_prepend(4294967295::bigint, flatten(list_transform(string_split(coalesce(doc_id::varchar, ''), ''),
           lambda c: [ascii(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda a, x: case when x >= 0 then xor(a, x) else xor(a >> 1, (a & 1) * 3988292384) end)"""
    leaves = f"""
with rows as materialized (
  select doc_id, source, sha256({head} || {field("text")}) as leaf,
         sha256({head} || {field(f"(case when xor({crc}, 4294967295) % 2 = 0 then replace(text, chr(10), '') else text end)")}) as current
  from documents
), placed as materialized (
  select *, dense_rank() over (order by source nulls first) - 1 as tree, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as lo,
         count(*) over (partition by source) as n
  from rows
), """
    own = levels("l", "select tree, lo, n, leaf as digest from placed", depth)
    forest = levels("s", f"select 0 as tree, tree as lo, count(*) over () as n, digest from l{depth}", forest_depth)
    low = folds("f", "l", "select doc_id, leaf, tree, lo, '' as proof, current as fold from placed", depth).replace("{key}", "tree")
    high = folds("g", "s", f"select * exclude (lo), tree as lo, 0 as zero from f{depth}", forest_depth).replace("{key}", "zero")
    return f"""{leaves}{own}, {forest}, {low}, {high}
select g.doc_id, g.leaf, l.digest as subroot, s.digest as root, sha256(g.proof) as proof_sha256, g.fold as folded_root, g.fold = s.digest as verified
from g{forest_depth} g join l{depth} l on g.tree = l.tree join s{forest_depth} s on s.tree = 0
"""


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_minhash": op3_minhash,
    "op4_language_id": op4_language_id,
    "op5_fingerprints": op5_fingerprints,
    "op6_packing": op6_packing,
    "op7_nearest": op7_nearest,
    "op8_quality": op8_quality,
    "op9_mixing": op9_mixing,
    "op10_lm_scores": op10_lm_scores,
    "op11_vector_codes": op11_vector_codes,
    "op12_decontaminate": op12_decontaminate,
    "op13_manifest": op13_manifest,
}

ORACLES = {"op2_suffix_dedup": OP2_SQL, "op3_minhash": OP3_SQL, "op9_mixing": OP9_SQL, "op11_vector_codes": _lloyd_sql(), "op12_decontaminate": OP12_SQL, "op13_manifest": _merkle_sql()}
