"""One query for each operator, over its whole tables, and SQL for those that SQL expresses."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskrank.llm.ann import nearest
from riskrank.llm.common import Workspace, read_table
from riskrank.llm.conversations import damage, figures, repair
from riskrank.llm.merkle import check_claims, document_manifest
from riskrank.llm.packing import pack_documents
from riskrank.llm.pages import extract
from riskrank.llm.pieces import encode_pieces
from riskrank.llm.quality import classify, fit_quality
from riskrank.llm.simhash import near_duplicates
from riskrank.llm.suffix_dedup import remove_repeats
from riskrank.llm.token_files import read_token_files, write_token_files
from riskrank.llm.topk import top_products
from riskrank.llm.url_filter import Rule, filter_urls
from riskrank.llm.warc import read_archives, records, write_archives

URL_RULES = [
    Rule("block", "net", "/"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
]


def op1_hilbert_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), Workspace(spark), every=50, k=5)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), Workspace(spark), unit="byte", threshold=50)


def op3_norm_sorted_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_products(read_table(spark, sf_dir, "embeddings"), Workspace(spark), scale=256.0, every=50, k=5)


def op4_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(
        read_table(spark, sf_dir, "documents"), model=public_tokenizers.path("piece_bpe_32k.model"), dropout=0.1, seed=7
    )


def op5_link_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read_table(spark, sf_dir, "pages"), Workspace(spark), URL_RULES)


def op6_min_bin_slack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(
        read_table(spark, sf_dir, "documents"),
        Workspace(spark),
        tokenizer=public_tokenizers.path("byte_bpe_50k.json"),
        capacity=2048,
        end_id=0,
    )


def op7_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, counts = write_token_files(
        read_table(spark, sf_dir, "documents"),
        Workspace(spark),
        tokenizer=public_tokenizers.path("word_bpe_49k.json"),
        vocabulary=49_408,
        end_id=1,
    )
    return read_token_files(manifest, counts)


def op8_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(read_table(spark, sf_dir, "pages"), Workspace(spark))
    read = records(read_archives(manifest, with_payload=False))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_site_bayes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = fit_quality(docs, read_table(spark, sf_dir, "labels"))
    return classify(docs, model, Workspace(spark))


def op10_simhash_ball(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), Workspace(spark), words=3, radius=2)


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return figures(repair(damage(read_table(spark, sf_dir, "conversations")), present="present"))


def op12_site_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"), Workspace(spark))


def op13_veb_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    even = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    without_ends = F.when(even, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    manifest = document_manifest(
        read_table(spark, sf_dir, "documents"), Workspace(spark), claimed={"text": without_ends}
    )
    return check_claims(manifest, with_path=False).drop("path")


def queries() -> dict:
    return {
        name: globals()[name] for name in sorted(globals()) if name.startswith("op") and callable(globals()[name])
    }


def _fields(text: str) -> str:
    """A record's fields in SQL, each with its length or as a dash."""
    names = ("doc_id", "source", "lang", "n_chars", text)
    return " || ".join(f"coalesce(strlen(cast({x} as varchar)) || ':' || {x}, '-')" for x in names)


# The article of the given pages, which mark it: paragraphs without tags, decoded, white space as one space.
_PAGES_SQL = """
    with article as (
        select page_id, url, regexp_replace(regexp_extract(html, '(?s)<article>(.*?)</article>', 1), '<br>', ' ', 'g') as body
        from pages
    ), blocks as (
        select page_id, url, list_filter(
            list_transform(
                string_split_regex(body, '</?(?:p|h1)>'),
                lambda x: trim(regexp_replace(
                    regexp_replace(regexp_replace(regexp_replace(regexp_replace(
                        regexp_replace(x, '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g'),
                    '\\s+', ' ', 'g'))
            ),
            lambda x: x <> ''
        ) as parts
        from article
    )
    select page_id, url, array_to_string(parts, chr(10)) as text, length(array_to_string(parts, chr(10))) as n_chars from blocks
"""

_ARCHIVE_SQL = """
    with p as (
        select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
    ), last as (
        select payload_bytes, payload_digest, max(page_id) as largest from p where payload_bytes >= 1000 group by all
    )
    select page_id, payload_bytes, payload_digest, case when largest <> page_id then 'revisit' else 'response' end as record_type,
           case when largest <> page_id then largest end as refers_to
    from p left join last using (payload_bytes, payload_digest)
"""

# The parity of a checksum bit by bit; trees level by level; then every row's way up, and up again over the groups.
_MANIFEST_SQL = f"""
    with recursive docs as (
        select *, sha256({_fields('text')}) as leaf, sha256({_fields("replace(text, chr(10), '')")}) as without_ends,
               list_reduce(
                   flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda d: [ascii(d), -1, -1, -1, -1, -1, -1, -1, -1])),
                   lambda a, x: case when x >= 0 then xor(a, x) else xor(a // 2, (a % 2) * 3988292384) end,
                   cast(4294967295 as bigint)
               ) % 2 = 1 as even
        from documents
    ), placed as (
        select *, row_number() over (partition by source order by doc_id) - 1 as pos, count(*) over (partition by source) as n from docs
    ), up as (
        select 0 as level, coalesce('=' || source, '') as tree, pos, n, leaf as h from placed
        union all
        select level + 1, tree, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' order by pos)) from up where n > 1
        group by level, tree, pos // 3, n
    ), subroots as (
        select tree, h as subroot, row_number() over (order by tree <> '', encode(tree)) - 1 as pos, count(*) over () as n from up where n = 1
    ), top as (
        select 0 as level, pos, n, subroot as h from subroots
        union all
        select level + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' order by pos)) from top where n > 1
        group by level, pos // 3, n
    ), nodes as (
        select tree, level, pos, n, h from up where n > 1 union all select null, level, pos, n, h from top where n > 1
    ), steps as (
        select a.tree, a.level, a.pos, coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos < a.pos), '') as before,
               coalesce(string_agg(b.h, '' order by b.pos) filter (b.pos > a.pos), '') as after
        from nodes a join nodes b on a.tree is not distinct from b.tree and a.level = b.level and a.pos // 3 = b.pos // 3
        group by all
    ), walk as (
        select doc_id, coalesce('=' || source, '') as tree, 0 as level, pos, '' as proof, case when even then without_ends else leaf end as folded
        from placed
        union all
        select w.doc_id, w.tree, w.level + 1, w.pos // 3, w.proof || s.before || s.after, sha256(s.before || w.folded || s.after)
        from walk w join steps s on s.tree = w.tree and s.level = w.level and s.pos = w.pos
    ), whole as (
        select doc_id, tree, max_by(proof, level) as proof, max_by(folded, level) as folded from walk group by doc_id, tree
    ), climb as (
        select w.doc_id, 0 as level, s.pos, w.proof, w.folded, s.subroot from whole w join subroots s using (tree)
        union all
        select c.doc_id, c.level + 1, c.pos // 3, c.proof || s.before || s.after, sha256(s.before || c.folded || s.after), c.subroot
        from climb c join steps s on s.tree is null and s.level = c.level and s.pos = c.pos
    ), ends as (
        select doc_id, max_by(proof, level) as proof, max_by(folded, level) as folded_root, any_value(subroot) as subroot from climb group by doc_id
    )
    select d.doc_id, d.leaf, e.subroot, r.h as root, sha256(e.proof) as proof_sha256, e.folded_root, e.folded_root = r.h as verified
    from docs d join ends e using (doc_id) cross join (select h from top where n = 1) r
"""


def oracle_sql() -> dict[str, str]:
    """Exact inner products, archives, articles and trees in SQL. The others need hashes or tokenizers that SQL lacks."""
    return {
        "op8_warc_salvage": _ARCHIVE_SQL,
        "op12_site_templates": _PAGES_SQL,
        "op13_veb_manifest": _MANIFEST_SQL,
        "op3_norm_sorted_topk": """
            with v as (
                select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
                from embeddings
            ), p as (
                select q.vec_id as query_id, c.vec_id,
                       cast(list_sum(list_transform(list_zip(q.e, c.e), lambda t: t[1] * t[2])) as bigint) as score
                from v q join v c on q.vec_id <> c.vec_id
                where q.vec_id % 50 = 0
            )
            select query_id, cast(rank as integer) as rank, vec_id, score
            from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
            where rank <= 5
        """
    }
