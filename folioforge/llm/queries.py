"""The queries of this subpackage and their SQL: thin forms of the operators over the tables of a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.llm import exact_dedup, jaccard_join, langid, line_dedup, mixing, neighbours, packing, quality, substring_dedup, token_files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True)


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"))


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("times")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


#: The tables' accented letters and single bytes that stand for them: DuckDB's levenshtein counts bytes.
ACCENTED = "ÊÄñäÜèéÍÉßêçíÇÈÑöüÖóÓáÁúÚ"
PLAIN = "".join(map(chr, [*range(1, 9), *range(14, 31)]))

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_substrings": op3_substrings,
    "op4_lines": op4_lines,
    "op5_quality": op5_quality,
    "op6_source_mix": op6_source_mix,
    "op7_jaccard": op7_jaccard,
    "op8_packing": op8_packing,
    "op9_neighbours": op9_neighbours,
    "op10_language": op10_language,
}

SQL = {
    "op2_exact_dedup": """
        with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
        select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
               doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
        from d""",
    "op6_source_mix": r"""
        with base as (
            select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
                   md5('mix:' || coalesce(cast(doc_id as varchar), 'null')) as k
            from documents),
        s as (select source, cast(sum(size) as bigint) as source_size from base group by source),
        w as (select *, [5, 2, 1][1 + (row_number() over (order by source nulls last) - 1) % 3]::double as weight,
                     row_number() over (order by source nulls last) as turn from s),
        c as (select *, source_size * 3 as cap, source_size * 3 / weight as per, sum(source_size) over () as total from w),
        r as (select *, row_number() over (order by per, turn) as pos,
                     cast(total - coalesce(sum(cap) over (order by per, turn rows between unbounded preceding and 1 preceding), 0) as double)
                     / sum(weight) over (order by per, turn rows between current row and unbounded following) as level from c),
        f as (select min(pos) as pos0, arg_min(level, pos) as level0 from r where level <= per),
        g as (select source, source_size, case when pos < pos0 then cast(cap as double) else weight * level0 end as target from r, f),
        o as (select b.doc_id, b.source, b.size, b.k, g.source_size, g.target,
                     sum(b.size) over (partition by b.source order by b.k, b.doc_id, b.size rows between unbounded preceding and current row) as c
              from base b join g on b.source is not distinct from g.source),
        i as (select o.*, e, case when target > 0 then cast(source_size * e + c as double) / target else 0.0 end as v
              from o, (select unnest([0, 1, 2]) as e)),
        q as (select *, sum(size) over (order by v, k, e, source range between unbounded preceding and current row) as run from i)
        select doc_id, size, source_size, target,
               cast(size * count(*) filter (where run <= (select sum(size) from base)) as bigint) as taken
        from q group by all""".replace("group by all", "group by doc_id, source, size, source_size, target, k"),
    "op3_substrings": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
        win as (select doc_id, p, array_to_string(w[p:p + 49], ' ') as k from d, unnest(generate_series(1, len(w) - 49)) as t(p)),
        least as (select k, min(doc_id) as m from win group by k),
        gone as (select distinct doc_id, p + o as i from win join least using (k), range(50) as r(o) where doc_id > m),
        words as (select doc_id, i, w[i] as word from d, unnest(generate_series(1, len(w))) as t(i)),
        kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by i) as t from words anti join gone using (doc_id, i) group by doc_id)
        select d.doc_id, cast(len(w) as bigint) as n_words, len(w) - coalesce(n, 0) as n_removed, sha256(coalesce(t, '')) as kept_sha256
        from d left join kept using (doc_id)""",
    "op7_jaccard": r"""
        with recursive d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
            from documents),
        sh as (
            select distinct doc_id, array_to_string(w[p:p + 4], ' ') as k
            from d, unnest(generate_series(1, greatest(len(w) - 4, 1))) as t(p) where len(w) > 0),
        n as (select doc_id, count(*) as n from sh group by doc_id),
        pairs as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b using (k) where a.doc_id < b.doc_id group by a.doc_id, b.doc_id),
        links as (select x, y from pairs join n a on a.doc_id = x join n b on b.doc_id = y where 100 * c >= 80 * (a.n + b.n - c)),
        edges as (select x, y from links union all select y, x from links),
        reach(doc_id, r) as (
            select doc_id, doc_id from documents
            union select reach.doc_id, edges.y from reach join edges on edges.x = reach.r)
        select doc_id, coalesce(n.n, 0) as n_shingles, component_id
        from (select doc_id, min(r) as component_id from reach group by doc_id) left join n using (doc_id)""",
    "op4_lines": rf"""
        with docs as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
        lines as (select distinct doc_id, i - 1 as p, ls[i] as line from docs, unnest(generate_series(1, len(ls))) as u(i)),
        firsts as (
            select line, min({{'d': doc_id, 'p': p}}) as f, len(line) as n, translate(line, '{ACCENTED}', '{PLAIN}') as code,
                   [len(line) - len(replace(line, c, '')) for c in ['e', 't', 'h', 'a', 'n', 'i', 'r', 's', 'o']] as c
            from lines where trim(line) <> '' group by line),
        late as (
            select distinct a.f from firsts a, range(-2, 3) as r(d) join firsts b on b.n = a.n + d
            where b.f < a.f
              and {" and ".join(f"abs(a.c[{i}] - b.c[{i}]) <= 2" for i in range(1, 10))}
              and levenshtein(a.code, b.code) <= 2),
        marked as (
            select l.*, trim(line) <> '' and (f < {{'d': doc_id, 'p': p}} or f in (select f from late)) as gone
            from lines l left join firsts using (line))
        select doc_id, count(*) as n_lines, cast(count(*) filter (where gone) as bigint) as n_removed,
               sha256(coalesce(string_agg(line, chr(10) order by p) filter (where gone is not true), '')) as kept_sha256
        from marked group by doc_id""",
}
