"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import alignment, html_text, licences, mixing, neighbours, packing, prefix_trie, quality, simhash, top_k, toxicity, url_filter, vector_links


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{table}.parquet")


def op1_html(spark: SparkSession, root: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(read(spark, root, "pages"))


def op2_quality(spark: SparkSession, root: str) -> DataFrame:
    """Quality score of every document, and whether it is kept."""
    return quality.judged(read(spark, root, "documents"))


def op3_simhash(spark: SparkSession, root: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(read(spark, root, "documents"), "doc_id", "text", size=3, radius=3)


def op4_toxicity(spark: SparkSession, root: str) -> DataFrame:
    """Expected severity of every document, and whether it counts as toxic."""
    return toxicity.judged(read(spark, root, "documents"), read(spark, root, "labels"))


def byte_bpe() -> str:
    """The vocabulary file that the packing queries use by default."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_packing(spark: SparkSession, root: str) -> DataFrame:
    """All documents packed into sequences of at most 1024 tokens."""
    return packing.packed(read(spark, root, "documents"), byte_bpe(), limits=packing.Limits(1_024, 1_024, 1_024))


def op6_mixing(spark: SparkSession, root: str) -> DataFrame:
    """Words that the mix takes of every document."""
    sized = read(spark, root, "documents").select("doc_id", "source", mixing.words("text").alias("size"))
    return mixing.mix(sized, F.col("size")).select(
        "row.doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source"
    )


#: Rules (host, path) of the mix of hosts in the tables.
PLACES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op7_url_filter(spark: SparkSession, root: str) -> DataFrame:
    """Verdict on the url of every page; words in the url decide where no rule on its place does."""
    rules = [url_filter.place(*x) for x in PLACES] + [url_filter.word("block", x) for x in url_filter.WORDS]
    found = url_filter.judged(read(spark, root, "pages"), url_filter.rule_table(spark, rules))
    of_place = F.when(F.col("rank") == 2, F.col("rule"))
    return found.select("page_id", "host", "path", of_place.alias("rule"), "verdict")


def op8_licences(spark: SparkSession, root: str) -> DataFrame:
    """Licence family of every document that carries a notice."""
    return licences.scan(read(spark, root, "documents"))


def op9_neighbours(spark: SparkSession, root: str) -> DataFrame:
    """The 5 nearest by cosine of every fiftieth vector, approximately."""
    return neighbours.neighbours(read(spark, root, "embeddings"), lambda key: key % 50 == 0)


def op10_top_k(spark: SparkSession, root: str) -> DataFrame:
    """The 5 highest integer inner products of every fiftieth vector."""
    return top_k.top_k(read(spark, root, "embeddings"), lambda key: key % 50 == 0)


def op11_links(spark: SparkSession, root: str) -> DataFrame:
    """Links of cosine 0.9 or more and component of every vector."""
    return vector_links.linked(read(spark, root, "embeddings"), least=0.9)


def op12_alignment(spark: SparkSession, root: str) -> DataFrame:
    """Aligned groups and links of the byte-level and the piece tokens of every document."""
    import public_tokenizers

    return alignment.aligned(read(spark, root, "documents"), byte_bpe(), public_tokenizers.path("piece_bpe_32k.model"))


def op13_trie(spark: SparkSession, root: str) -> DataFrame:
    """The trie of all rebuilt conversations by their first turns."""
    return prefix_trie.trie(read(spark, root, "conversations"))


QUERIES = [op1_html, op2_quality, op3_simhash, op4_toxicity, op5_packing, op6_mixing, op7_url_filter, op8_licences, op9_neighbours, op10_top_k, op11_links, op12_alignment, op13_trie]

OP7_SQL = """
with cut as (
    select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest
    from pages
), parts as (
    select page_id,
           translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path
    from cut
), ruled as (
    select *, case
        when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
        when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
        when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
        when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/'
    end as rule
    from parts
)
select page_id, host, path, rule, case
    when rule in ('com/', 'www.example.com/en/') then 'allow'
    when rule is not null then 'block'
    when regexp_matches(host || path, '(?i)(^|[^a-z0-9])(@words)([^a-z0-9]|$)') then 'block'
    else 'allow'
end as verdict
from ruled
""".replace("@words", "|".join(url_filter.WORDS))

OP10_SQL = """
with numbered as (
    select row_number() over () as nr, vec_id, embedding from embeddings
), whole as (
    select nr, vec_id, [floor(256 * x::double) for x in embedding] as e
    from numbered
    where len(embedding) > 0 and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scored as (
    select q.nr, q.vec_id as query_id, c.vec_id, list_dot_product(q.e, c.e)::bigint as score
    from whole q join whole c on q.vec_id % 50 = 0 and q.nr <> c.nr
)
select query_id, row_number() over (partition by nr order by score desc, vec_id nulls last)::integer as rank, vec_id, score
from scored
qualify rank <= 5
"""

OP11_SQL = """
with recursive numbered as (
    select row_number() over () as nr, vec_id, [x::double for x in embedding] as v from embeddings
), good as (
    select * from numbered
    where len(v) > 0 and len([x for x in v if x is null or not isfinite(x)]) = 0 and len([x for x in v if x <> 0]) > 0
), links as (
    select a.nr as a, b.nr as b from good a join good b on a.nr <> b.nr
    where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.9
), reach as (
    select nr as a, nr as b from numbered
    union
    select r.a, l.b from reach r join links l on r.b = l.a
), least as (
    select r.a as nr, min(n.vec_id) as component_id from reach r join numbered n on r.b = n.nr group by r.a
), counts as (
    select a as nr, count(*) as n_links from links group by a
)
select vec_id, coalesce(n_links, 0)::bigint as n_links, component_id, vec_id is not distinct from component_id as kept
from numbered join least using (nr) left join counts using (nr)
"""

OP13_SQL = """
with placed as (
    select conv_id, coalesce(role, '') as role, coalesce(text, '') as text,
           row_number() over (partition by conv_id order by turn nulls first, role nulls first, text) as pos
    from conversations where conv_id is not null
), own as (
    select conv_id, list({'role': role, 'text': text} order by pos) as turns from placed group by conv_id
), heads as (
    select conv_id, turns, conv_id - conv_id % 100 as base, xor(4294967295::bigint, list_reduce(
        list_prepend(4294967295::bigint, [ascii(c)::bigint for c in string_split(conv_id::varchar, '')]),
        lambda crc, c: list_reduce(
            list_prepend(xor(crc, c), [0::bigint, 0, 0, 0, 0, 0, 0, 0]),
            lambda s, i: case when s % 2 = 1 then xor(s // 2, 3988292384::bigint) else s // 2 end
        )
    )) % 6 as h
    from own
), rebuilt as (
    select c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) as turns
    from heads c left join own b on c.base = b.conv_id
), prefixes as (
    select conv_id, turns[1:d] as node, d, d = len(turns) as ends
    from (select conv_id, turns, unnest(range(len(turns) + 1)) as d from rebuilt)
), nodes as (
    select node, d as depth, min(conv_id) as conv_id, count(*) as n_convs,
           sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '')) as ends_sha256
    from prefixes group by node, d
), kids as (
    select n.*, p.conv_id as parent_conv_id, coalesce(k.n_children, 0) as n_children
    from nodes n
    left join nodes p on n.depth > 0 and p.depth = n.depth - 1 and p.node = n.node[1:n.depth - 1]
    left join (select depth - 1 as depth, node[1:depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by all) k
        on k.depth = n.depth and k.node = n.node
), sums as (
    select node[1:a] as node, a as depth, sum((n_children = 0)::bigint) as n_leaves,
           sum(case when depth > 0 then (n_convs - 1) * length(node[depth].text) else 0 end) as saved_tokens
    from (select *, unnest(range(depth + 1)) as a from kids) group by 1, 2
)
select k.conv_id, k.depth::bigint as depth, k.parent_conv_id, k.n_convs, k.n_children::bigint as n_children,
       s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, k.ends_sha256
from kids k join sums s on k.depth = s.depth and k.node = s.node
"""

ORACLE_SQL: dict[str, str] = {"op7_url_filter": OP7_SQL, "op10_top_k": OP10_SQL, "op11_links": OP11_SQL, "op13_trie": OP13_SQL}
