"""The operators' queries over the given tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventlake.llm import (
    attention_lm,
    binary_records,
    collocations,
    decontaminate,
    filter_audit,
    fingerprint,
    language_id,
    license_scan,
    line_dedup,
    ngram_join,
    packing,
    private_spans,
    quality,
)
from eventlake.llm.store import table
from eventlake.scratch import new_folder

Query = Callable[[SparkSession, str], DataFrame]


def op1_ordinal_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    grade = quality.grade_of(F.col("quality"), F.col("toxic"))
    ratings = labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade"))
    weights, thresholds = quality.fit(docs, ratings, grades=3)
    good = F.element_at("tails", 2)
    return quality.score(docs, weights, thresholds).select(
        "doc_id", "expected_grade", good.alias("p_good"), (good >= 0.7).alias("keep")
    )


def op2_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf, "documents"), width=3, percent=90)


def op3_template_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


def op4_consistent_sampling(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf, "documents"))


def op5_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return license_scan.scan(table(spark, sf, "documents"))


def op7_attention_lm(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return attention_lm.score(table(spark, sf, "documents"), path, vocabulary_size=50_257)


def op8_cross_parsing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language_id.identify(docs, language_id.learn(docs, modulus=4, remainder=2))
    return found.select(
        "doc_id",
        F.coalesce(language_id.held_out(F.col("doc_id"), 4, 2), F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
        "bits_per_char",
    )


def op6_binary_records(spark: SparkSession, sf: str) -> DataFrame:
    folder = new_folder(spark, "records")
    path = public_tokenizers.path("byte_bpe_50k.json")
    binary_records.write_records(table(spark, sf, "documents"), folder, path, spaces=True, end_id=0)
    index = binary_records.with_starts(binary_records.build_index(spark, folder))
    return index.select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "position")


def op9_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(table(spark, sf, "documents"), path, capacity=2048, spaces=False, end_id=0)


def op10_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf, "documents"))
    return found.select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op12_private_spans(spark: SparkSession, sf: str) -> DataFrame:
    return private_spans.scan(table(spark, sf, "documents"))


def op13_collocations(spark: SparkSession, sf: str) -> DataFrame:
    return collocations.collocations(table(spark, sf, "documents"), support=30, top=2000)


def queries() -> dict[str, Query]:
    return {
        "op1_ordinal_quality": op1_ordinal_quality,
        "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
        "op3_template_decontamination": op3_template_decontamination,
        "op4_consistent_sampling": op4_consistent_sampling,
        "op5_license_scan": op5_license_scan,
        "op6_binary_records": op6_binary_records,
        "op7_attention_lm": op7_attention_lm,
        "op8_cross_parsing": op8_cross_parsing,
        "op9_best_fit_packing": op9_best_fit_packing,
        "op10_line_dedup": op10_line_dedup,
        "op11_filter_audit": op11_filter_audit,
        "op12_private_spans": op12_private_spans,
        "op13_collocations": op13_collocations,
    }


# Every order is walked filter by filter, without ranks or intervals.
AUDIT_SQL = r"""
with doc as (
    select doc_id, coalesce(lang, '') as part, coalesce(text, '') as t from documents
), word as (
    select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as w from doc
), least_id as (select t, min(doc_id) as least from doc group by t),
label as (
    select doc_id as label_id, max(coalesce(quality, 0) = 1) as good, max(coalesce(toxic, 0) = 1) as toxic
    from labels group by doc_id
), fail as (
    select part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
        case when len(w) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(w)) < 50 * len(w) then 'B' else '' end
        || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 3 * length(t) then 'C' else '' end
        || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
        || case when doc_id > least then 'E' else '' end as failed
    from word join least_id using (t) left join label on doc_id = label_id
), mask as (
    select part, failed, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from fail group by all
), letter(f) as (values ('A'), ('B'), ('C'), ('D'), ('E')),
orders as (
    select a.f || b.f || c.f || d.f || e.f as filter_order from letter a, letter b, letter c, letter d, letter e
    where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), place as (
    select filter_order, step, filter_order[step] as f, filter_order[1:step - 1] as before
    from orders, range(1, 6) as s(step)
), cell as (
    select part, filter_order, step, f,
        sum(n) filter (not hit_before) as here, sum(n) filter (hit and not hit_before) as removed,
        sum(n) filter (hit and hit_before) as redundant, sum(n) filter (failed = f) as unique_fails,
        sum(good) filter (hit and not hit_before) as good_lost,
        sum(toxic) filter (hit and not hit_before) as toxic_lost
    from (select *, contains(failed, f) as hit,
            len(list_intersect(string_split(failed, ''), string_split(before, ''))) > 0 and before <> '' as hit_before
        from mask, place)
    group by part, filter_order, step, f
)
select part, filter_order, cast(step as integer) as step,
    cast(coalesce(here, 0) - coalesce(removed, 0) as bigint) as kept,
    cast(coalesce(removed, 0) as bigint) as removed, cast(coalesce(redundant, 0) as bigint) as redundant,
    cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
    cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
    cast(sum(coalesce(removed, 0)) over (partition by part, f) as bigint) as shapley
from cell
"""


# All phrases are counted at once, without shards or candidates.
COLLOCATION_SQL = r"""
with piece as (
    select coalesce(lang, 'und') as lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), word as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from piece),
total as (select lang, sum(len(w)) as n from word group by lang),
gram as (
    select lang, k, unnest([array_to_string(w[i:i + k - 1], ' ') for i in range(1, len(w) - k + 2)]) as phrase
    from word, range(1, 5) as o(k)
), f as (select lang, k, phrase, count(*) as f from gram group by all having count(*) >= 30),
candidate as (select lang, phrase, f as a, string_split(phrase, ' ') as w from f where k > 1),
cut as (
    select c.lang, c.phrase, a, w, c.k, l.f as l, r.f as r, 2000000 * a // (l.f + r.f) as score
    from (select *, unnest(range(1, len(w))) as k from candidate) c
    join f l on l.lang = c.lang and l.phrase = array_to_string(w[1:c.k], ' ')
    join f r on r.lang = c.lang and r.phrase = array_to_string(w[c.k + 1:], ' ')
), lowest as (
    select * from cut qualify row_number() over (partition by lang, phrase order by score, k) = 1
), inside as (
    select lang, array_to_string(w[i:i + s - 1], ' ') as phrase, max(a) as longer
    from candidate, range(2, 4) as x(s), range(1, 4) as y(i)
    where s < len(w) and i + s - 1 <= len(w) group by 1, 2
), ranked as (
    select o.*, row_number() over (partition by o.lang order by score desc, a desc, encode(o.phrase)) as rank
    from lowest o left join inside i on i.lang = o.lang and i.phrase = o.phrase
    where longer is null or 100 * longer < 80 * a
)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score
from ranked join total using (lang) where rank <= 2000
"""


def oracle_sql() -> dict[str, str]:
    return {"op11_filter_audit": AUDIT_SQL, "op13_collocations": COLLOCATION_SQL}
