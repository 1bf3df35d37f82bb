"""Queries of the training-data operators: one ``opN_<name>`` per operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import (
    chat_format, lexical_search, main_text, maxent_lm, ngram_ratio, piece_codec, prefix_trie, prob_minhash, redirects, rule_ensemble,
    scaled_sketch, toxicity, vector_packing)
from tripmart.llm.common import materialize
from tripmart.llm.labelled import fold_of, usable
from tripmart.sources.adapter import table

QUERIES = {}
ORACLE = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text that they decode to, as digests."""
    path = public_tokenizers.path("piece_bpe_32k.model")
    done = piece_codec.decode(piece_codec.encode(table(spark, sf_dir, "documents"), path), path)
    return done.select(
        F.col("id").alias("doc_id"), F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    pieces = vector_packing.tokenised_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return vector_packing.pack(spark, pieces).withColumnRenamed("id", "doc_id")


@query
def op2_ngram_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the log-likelihood ratio; good labelled rows are the trusted target."""
    trusted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return ngram_ratio.filter_by_ratio(spark, table(spark, sf_dir, "documents"), trusted).withColumnRenamed("id", "doc_id")


CONTROL_CASE = "\\### Assistant: </turn> ok"


@query
def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one with control strings, read back from their formatted texts."""
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_CASE).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    read = chat_format.read_back(chat_format.format_conversations(rows))
    turn = lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", turn), ""), 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid")


ORACLE["op3_chat_format"] = f"""
with c as (
  select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
  union all select -7, 0, 'user', '{CONTROL_CASE}' union all select -7, 1, 'assistant', '{CONTROL_CASE}'),
o as (
  select *, lag(r) over w as before, lead(r) over w as after,
    replace(replace(replace(t, '\\', '\\b'), '<turn ', '\\o'), '</turn>', '\\c') as safe,
    replace(replace(replace(replace(r, '\\', '\\b'), '<turn ', '\\o'), '</turn>', '\\c'), '>', '\\r') as safe_role
  from c window w as (partition by conv_id order by turn nulls first, r, t))
select conv_id, count(*) as n_turns,
  sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn nulls first, r, t)) as turns_sha256,
  cast(coalesce(sum(length(t)) filter (r = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn nulls first, r, t) filter (r = 'assistant'), '')) as loss_sha256,
  cast(sum(length(safe) + length(safe_role) + 14) as bigint) as formatted_chars,
  bool_and(case when before is null then r in ('system', 'user')
                when before = 'system' then r = 'user' when before = 'user' then r = 'assistant'
                when before = 'assistant' then r = 'user' else false end
           and (after is not null or r = 'assistant')) as valid
from o group by conv_id"""


@query
def op4_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text, and their likeness."""
    c = scaled_sketch.compare_with_edits(spark, table(spark, sf_dir, "documents"))
    own, edited, after = F.col("own"), F.col("edited"), F.col("next")
    return c.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"),
        scaled_sketch.as_text(own).alias("fingerprint"), scaled_sketch.as_text(edited).alias("edited_fingerprint"),
        scaled_sketch.likeness(own, edited).alias("near_edited"), scaled_sketch.likeness(own, after).alias("near_next"),
        scaled_sketch.containment(own, edited).alias("kept_in_edited"))


URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op1_redirects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's rule and verdict; blocks reach aliases."""
    rules = redirects.rule_table(spark, URL_RULES)
    return redirects.judge_pages(table(spark, sf_dir, "pages"), rules).withColumnRenamed("id", "page_id")


def _normal_sql(url: str) -> str:
    """The normal form of an url in SQL."""
    rest = f"case when contains({url}, '://') then substr({url}, instr({url}, '://') + 3) else '' end"
    host = f"translate(regexp_extract({rest}, '^[^/?#]*'), '{redirects.UPPER}', '{redirects.LOWER}')"
    path = f"regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1)"
    query_part = (f"regexp_replace(regexp_replace(regexp_extract({rest}, '^[^?#]*\\?([^#]*)', 1), '{redirects.TRACKING}', '', 'g'), '^&', '')")
    return (f"case when {host} <> '' then 'http://' || regexp_replace({host}, '^(www|m)\\.', '') || "
            f"regexp_replace({path}, '(/index)?(\\.html?)?/*$', '') || "
            f"case when {query_part} <> '' then '?' || {query_part} else '' end end")


def _sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


_LINK = ("case when regexp_matches(link, '(?i)^https?://') then link when starts_with(link, '//') then 'http:' || link "
         "when starts_with(link, '/') then 'http://' || host || link "
         f"when not regexp_matches(link, {_sql_text(redirects.NOT_RELATIVE)}) then 'http://' || host || "
         "case when path = '' then '/' else regexp_replace(path, '[^/]*$', '') end || regexp_replace(link, '^(\\./)+', '') end")
ORACLE["op1_redirects"] = f"""
with recursive p as (
  select page_id, url, html, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
h as (
  select page_id, url, html, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{redirects.UPPER}', '{redirects.LOWER}') as host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) as path, {_normal_sql('url')} as a from p),
l as (
  select a, host, path, unnest([regexp_extract(regexp_extract(html, {_sql_text(redirects.CANONICAL_TAG)}), {_sql_text(redirects.HREF)}, 1),
    regexp_extract(regexp_extract(html, {_sql_text(redirects.REFRESH_TAG)}), {_sql_text(redirects.REFRESH_URL)}, 1)]) as link from h),
t as (select a, {_LINK} as target from (select a, host, path, trim(link) as link from l where link <> '')),
e as (select a, {_normal_sql('target')} as b from t),
both_ways as (select a, b from e where b is not null union select b, a from e where b is not null),
reach as (select a, b from both_ways union select r.a, x.b from reach r join both_ways x on r.b = x.a),
keys as (select a from h where a is not null union select a from both_ways),
comp as (select k.a, least(k.a, coalesce(min(r.b), k.a)) as component from keys k left join reach r on r.a = k.a group by k.a),
rules(action, rule) as (values {', '.join(f"('{a}', '{r}')" for a, r in URL_RULES)}),
nodes as (
  select distinct url as node, a as k from h where url is not null union select a, a from keys),
parts as (
  select node, k, translate(regexp_extract(rest, '^[^/?#]*'), '{redirects.UPPER}', '{redirects.LOWER}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select *, case when contains(node, '://') then substr(node, instr(node, '://') + 3) else '' end as rest from nodes)),
ruled as (
  select node, any_value(k) as k, arg_max(rule, length(rule)) as rule, arg_max(action, length(rule)) as action
  from parts join rules on (host = split_part(rule, '/', 1) or ends_with(host, '.' || split_part(rule, '/', 1)))
    and starts_with(path, substr(rule, instr(rule, '/')))
  group by node),
groups as (
  select component, bool_or(action = 'block') and not bool_or(action = 'allow') as inherited
  from ruled join comp on comp.a = ruled.k group by component)
select h.page_id, h.host, h.path, ruled.rule,
  coalesce(ruled.action, case when groups.inherited then 'block' else 'allow' end) as verdict
from h left join ruled on ruled.node = h.url left join comp on comp.a = h.a left join groups on groups.component = comp.component"""


#: Scores from which a document counts as good or toxic.
QUALITY_FROM, TOXIC_FROM = 0.5, 0.7


def _scored(rows: DataFrame, threshold: float) -> DataFrame:
    """doc_id, held_out, score, predicted of rows with ``id`` and ``score``."""
    return rows.select(F.col("id").alias("doc_id"), (fold_of(F.col("id"), 3) == 1).alias("held_out"), "score",
                       (F.col("score") >= threshold).cast("int").alias("predicted"))


def learned_labels(labels: DataFrame, label: str) -> DataFrame:
    """The label rows that a model may learn from."""
    return usable(labels, label).where(fold_of(F.col("label_id"), 3) != 1)


@query
def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by the rule ensemble."""
    stats = materialize(rule_ensemble.with_statistics(table(spark, sf_dir, "documents")), "statistics")
    labels = learned_labels(table(spark, sf_dir, "labels"), "quality")
    rows = materialize(stats.join(labels, F.col("id") == F.col("label_id")).select("stats", "label"), "labelled")
    return _scored(stats.select("id", rule_ensemble.fit(rows).score(F.col("stats")).alias("score")), QUALITY_FROM)


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the counterfactually regularised classifier."""
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, learned_labels(table(spark, sf_dir, "labels"), "toxic"))
    return _scored(toxicity.score(docs, model), TOXIC_FROM)


@query
def op10_prob_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return prob_minhash.classes(spark, table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


@query
def op5_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document by the unigram base and by the maximum-entropy model."""
    scored = maxent_lm.train_and_score(spark, table(spark, sf_dir, "documents"), fold_of(F.col("doc_id"), 5) != 1)
    return scored.select(F.col("id").alias("doc_id"), (~F.col("training")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


@query
def op11_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    rows = main_text.extract(table(spark, sf_dir, "pages"))
    return rows.select(F.col("id").alias("page_id"), "url", "text", F.char_length("text").cast("long").alias("n_chars"))


# The tables' pages hold one article of headings and paragraphs, which SQL can cut out by its tags.
ORACLE["op11_main_text"] = r"""
with a as (select page_id, url, coalesce(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '') as article from pages),
b as (
  select page_id, url, list_filter(list_transform(regexp_split_to_array(article, '</?(?:h1|p)>'), lambda x: trim(regexp_replace(
    replace(replace(replace(replace(regexp_replace(regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '&amp;?', '&#38', 'g'),
      '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&#38', '&'), '\s+', ' ', 'g'))), lambda x: x <> '') as blocks from a)
select page_id, url, coalesce(array_to_string(blocks, chr(10)), '') as text, length(coalesce(array_to_string(blocks, chr(10)), '')) as n_chars
from b"""


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nodes of the rebuilt conversations' prefix trie."""
    turns = prefix_trie.rebuilt(table(spark, sf_dir, "conversations"))
    return prefix_trie.nodes(spark, turns)


# The remainder of the unsigned crc32 of a decimal, bit by bit.
_HEAD_SQL = """cast(xor(list_reduce(list_concat([4294967295::bigint], flatten(list_transform(string_split(cast(c as varchar), ''),
  lambda x: list_transform(range(8), lambda i: (ascii(x)::bigint >> i) & 1)))),
  lambda r, b: case when (r & 1) <> b then xor(r >> 1, 3988292384::bigint) else r >> 1 end), 4294967295::bigint) % 9 as bigint)"""
ORACLE["op12_prefix_trie"] = f"""
with t as (
  select *, row_number() over (partition by c order by turn nulls first, sha256(turn_text)) as i
  from (select conv_id as c, turn, strlen(coalesce(text, '')) as bytes,
    strlen(coalesce(role, '')) || ':' || coalesce(role, '') || strlen(coalesce(text, '')) || ':' || coalesce(text, '') as turn_text
    from conversations where conv_id is not null)),
k as (select c, {_HEAD_SQL} as h from (select distinct c from t)),
r as (
  select k.c, t.i, 0 as own, t.turn_text, t.bytes from k join t on t.c = k.c - k.c % 5 and t.i <= k.h
  union all select k.c, t.i, 1, t.turn_text, t.bytes from k join t on t.c = k.c and t.i > k.h),
p as (
  select c, row_number() over w as depth, bytes, sha256(string_agg(turn_text, '') over w) as prefix
  from r window w as (partition by c order by own, i)),
a as (select c, 0 as depth, 0 as bytes, '' as prefix from k union all select c, depth, bytes, prefix from p),
e as (select c, max(depth) as depth from a group by c),
n as (
  select a.depth, a.prefix, min(a.c) as conv_id, count(*) as n_convs, any_value(a.bytes) as bytes,
    sha256(coalesce(string_agg(cast(a.c as varchar), ',' order by a.c) filter (e.depth = a.depth), '')) as ends_sha256
  from a join e using (c) group by a.depth, a.prefix),
up as (
  select n.depth, n.prefix, n.n_convs, n.bytes, x.depth as over_depth, x.prefix as over_prefix
  from n join a x on x.c = n.conv_id and x.depth <= n.depth),
kids as (select over_depth as depth, over_prefix as prefix, count(*) as n_children from up where depth = over_depth + 1 group by all),
sums as (
  select over_depth as depth, over_prefix as prefix, sum((n_convs - 1) * bytes) as saved_tokens,
    count(*) filter (not exists (select 1 from kids where kids.depth = up.depth and kids.prefix = up.prefix)) as n_leaves
  from up group by all)
select n.conv_id, n.depth, m.conv_id as parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) as n_children, sums.n_leaves,
  cast(sums.saved_tokens as bigint) as saved_tokens, n.ends_sha256
from n join sums using (depth, prefix) left join kids using (depth, prefix)
left join (select up.depth, up.prefix, n.conv_id from up join n on n.depth = up.over_depth and n.prefix = up.over_prefix
  where up.depth = up.over_depth + 1) m on m.depth = n.depth and m.prefix = n.prefix"""


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), 10)


_TERMS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
ORACLE["op13_lexical_search"] = f"""
with d as (select row_number() over () as doc, doc_id, {_TERMS_SQL} as terms from documents),
q as (select distinct item_id, translate(unnest({_TERMS_SQL}), '{redirects.UPPER}', '{redirects.LOWER}') as term from benchmark),
s as (select count(*) filter (len(terms) > 0) as n_docs, sum(len(terms))::bigint as all_terms from d),
o as (select doc, any_value(doc_id) as doc_id, any_value(len(terms))::bigint as n, term, count(*) as tf
  from (select doc, doc_id, terms, translate(unnest(terms), '{redirects.UPPER}', '{redirects.LOWER}') as term from d) group by doc, term),
w as (select term, cast(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) as bigint) as w from o, s group by term, n_docs),
sums as (
  select item_id, doc, any_value(doc_id) as doc_id,
    cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // all_terms)))) as bigint) as score
  from q join o using (term) join w using (term), s group by item_id, doc),
ranked as (
  select item_id, doc_id, score, row_number() over (partition by item_id order by score desc, doc_id nulls first) as rank
  from sums where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10"""
