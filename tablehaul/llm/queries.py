"""One query for each operator over the whole test tables, and its SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablehaul.llm.counts import count_tokens
from tablehaul.llm.leaks import benchmark_leaks
from tablehaul.llm.licenses import find_licenses
from tablehaul.llm.lines import drop_common_lines
from tablehaul.llm.minhash import near_duplicates
from tablehaul.llm.packing import pack
from tablehaul.llm.phrases import mine_phrases
from tablehaul.llm.quality import quality_scores
from tablehaul.llm.resample import resample
from tablehaul.llm.secrets import find_secrets, secret_digest
from tablehaul.llm.suffixes import drop_repeats
from tablehaul.llm.vectors import near_vectors
from tablehaul.llm.wavelet import read_tokens, write_tokens
from tablehaul.shared import new_folder


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op2_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    write_tokens(_table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), end_id=2)
    return read_tokens(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digest(find_secrets(_table(spark, sf_dir, "documents")))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_common_lines(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256")
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=0)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
        "offset",
    )


def op6_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(_table(spark, sf_dir, "embeddings"))


def op7_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return drop_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        "kept_sha256",
    )


def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(_table(spark, sf_dir, "documents"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    labels = _table(spark, sf_dir, "labels").where(fold != 0)
    scored = quality_scores(_table(spark, sf_dir, "documents"), labels)
    return scored.select(
        "doc_id", (fold == 0).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_phrases(_table(spark, sf_dir, "documents"))


def op12_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = count_tokens(_table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("n_words")


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_wavelet": op2_wavelet,
    "op3_secrets": op3_secrets,
    "op4_lines": op4_lines,
    "op5_packing": op5_packing,
    "op6_vectors": op6_vectors,
    "op7_suffixes": op7_suffixes,
    "op8_leaks": op8_leaks,
    "op9_licenses": op9_licenses,
    "op10_quality": op10_quality,
    "op11_phrases": op11_phrases,
    "op12_counts": op12_counts,
    "op13_resample": op13_resample,
}

ORACLES = {
    "op11_phrases": r"""
        with piece as (
            select coalesce(lang, 'und') as lang, row_number() over () as nr, unnest(regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[.,;:!?\n\x0b\x0c\r]'
            )) as piece from documents
        ), cut as (
            select lang, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda w: w <> '') as w from piece
        ), gram as (
            select lang, size, unnest(list_transform(
                range(1, len(w) - size + 2), lambda i: array_to_string(w[i : i + size - 1], ' ')
            )) as phrase from cut, (values (1), (2), (3)) as sizes(size) where len(w) >= size
        ), counted as (
            select lang, size, phrase, count(*)::hugeint as f from gram group by all
        ), total as (
            select lang, sum(f) as n from counted where size = 1 group by lang
        ), candidate as (select * from counted where size > 1 and f >= 10),
        cuts as (
            select lang, phrase, size, f as a, k,
                array_to_string(string_split(phrase, ' ')[1 : k], ' ') as one,
                array_to_string(string_split(phrase, ' ')[k + 1 :], ' ') as two
            from candidate, (values (1), (2)) as places(k) where k < size
        ), scored as (
            select cuts.lang, cuts.phrase, cuts.size, a, k, x.f as l, y.f as r,
                1000000::hugeint * a * a // (x.f * y.f) as score
            from cuts
            join counted x on x.lang = cuts.lang and x.phrase = one and x.size = k
            join counted y on y.lang = cuts.lang and y.phrase = two and y.size = cuts.size - k
        ), lowest as (
            select * from scored
            qualify row_number() over (partition by lang, phrase, size order by score, k) = 1
        ), longer as (
            select lang, unnest([
                array_to_string(string_split(phrase, ' ')[1 : 2], ' '), array_to_string(string_split(phrase, ' ')[2 :], ' ')
            ]) as phrase, f from candidate where size = 3
        ), inside as (select lang, phrase, max(f) as f from longer group by all),
        alive as (
            select lowest.* from lowest left join inside
            on size = 2 and inside.lang = lowest.lang and inside.phrase = lowest.phrase
            where inside.f is null or 100 * inside.f < 50 * a
        ), ranked as (
            select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from alive
        )
        select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
            score::bigint as score
        from ranked join total using (lang) where rank <= 2000
    """,
    "op6_vectors": """
        with recursive unit as (
            select vec_id, label, embedding::double[] as v from embeddings
            where label is not null and embedding is not null
                and isfinite(list_dot_product(embedding::double[], embedding::double[]))
                and list_dot_product(embedding::double[], embedding::double[]) > 0
        ), link as (
            select a.vec_id as a, b.vec_id as b from unit a join unit b
            on a.label = b.label and a.vec_id <> b.vec_id and len(a.v) = len(b.v)
                and list_cosine_similarity(a.v, b.v) >= 0.93
        ), reach as (
            select a, b from link
            union
            select reach.a, link.b from reach join link on reach.b = link.a
        ), low as (select a, min(b) as b from reach group by a),
        counted as (select a, count(*) as n from link group by a)
        select vec_id, coalesce(n, 0) as n_links, least(vec_id, coalesce(b, vec_id)) as component_id,
            least(vec_id, coalesce(b, vec_id)) = vec_id as kept
        from embeddings left join low on vec_id = low.a left join counted on vec_id = counted.a
    """,
    "op4_lines": r"""
        with cut as (
            select doc_id, row_number() over () as nr, string_split(coalesce(text, ''), chr(10)) as lines
            from documents
        ), line as (
            select nr, unnest(lines) as line, generate_subscripts(lines, 1) as place from cut
        ), keyed as (
            select *, translate(
                trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
            ) as key from line
        ), common as (
            select key from keyed where key <> '' group by key having count(distinct nr) >= 10
        ), judged as (
            select keyed.*, common.key is not null as gone
            from keyed left join common on keyed.key = common.key
        ), whole as (
            select nr, count(*) as n_lines, count(*) filter (gone) as n_dropped,
                coalesce(string_agg(line, chr(10) order by place) filter (not gone), '') as kept
            from judged group by nr
        )
        select doc_id, n_lines, n_dropped, sha256(kept) as kept_sha256
        from cut join whole using (nr)
    """,
}
