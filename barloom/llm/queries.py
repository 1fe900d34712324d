"""Registered queries of the corpus operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import chat, decontamination, exact_copies, language_model, merkle, mixing, near_duplicates, personal_data, quality, sharding, token_files, url_filter, whitening
from barloom.llm.common import table, text_bytes
from barloom.session import Workspace

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op1_histogram_shards(spark, sf_dir):
    """All documents in 16 shards of nearly equal bytes."""
    rows = sharding.document_shards(table(spark, sf_dir, "documents"), Workspace(spark, "op1"))
    return rows.select(
        "doc_id",
        (text_bytes() + 1).alias("size"),
        F.coalesce(F.crc32(F.col("text")), F.lit(0)).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op10_host_quality(spark, sf_dir):
    """Rules of every document and the verdict of its host."""
    rows = quality.judge(table(spark, sf_dir, "documents"), Workspace(spark, "op10"))
    return rows.select("doc_id", *quality.MEASURES, "base_failed", "kept", "host", "host_rule", F.round("host_rate", 9).alias("host_rate"))


ORACLE["op10_host_quality"] = r"""
with t as (select row_number() over () r, doc_id, coalesce(source, '') host, coalesce(text, '') t from documents),
w as (
  select *, regexp_extract_all(t, '[^\x09-\x0D ]+') ws,
         [l for l in string_split(t, chr(10)) if regexp_matches(l, '[^\x09-\x0D ]')] lines from t),
windows as (select r, i, ws[i:i + 2] win from w, unnest(range(1, len(ws) - 1)) x(i)),
twice as (select r, win from windows group by all having count(*) > 1),
repeated as (select r, count(distinct j) n from (select r, unnest([i, i + 1, i + 2]) j from windows semi join twice using (r, win)) group by r),
m as (
  select r, doc_id, host, len(ws) n_words, coalesce(list_sum([length(x) for x in ws]), 0)::bigint word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) n_symbols, len(lines) - len(list_distinct(lines)) n_dup_lines,
         coalesce(n, 0) n_repeat_words
  from w left join repeated using (r)),
f as (
  select *, n_words < 50 few_words, 100 * n_repeat_words > 50 * n_words repetition, 10 * n_symbols > word_chars symbols,
         20 * n_dup_lines > n_words repeated_lines, word_chars < 3 * n_words or word_chars > 12 * n_words odd_words from m),
flags as (
  select host, unnest(['few_words', 'repetition', 'symbols', 'repeated_lines', 'odd_words']) rule,
         unnest([few_words, repetition, symbols, repeated_lines, odd_words]) bad from f),
hosts as (select host, rule, count(*)::double n, count(*) filter (bad)::double f from flags group by all),
s as (select rule, count(*) h, sum(n) n, sum(f) f, sum(f * f / n) q, (sum(f) + 0.5) / (sum(n) + 1) mean from hosts group by rule),
b as (select *, q / n - (f / n) ** 2 - mean * (1 - mean) * h / n between_hosts from s),
p as (select rule, mean, case when between_hosts > 0 then least(greatest(mean * (1 - mean) / between_hosts - 1, 1), 1e6) else 1e6 end k from b),
rates as (select host, rule, n + k weight, (f + mean * k) / (n + k) rate from hosts join p using (rule)),
bounds as (select host, rule, rate, rate - 2 * sqrt(rate * (1 - rate) / (weight + 1)) bound from rates),
worst as (select * from bounds qualify row_number() over (partition by host order by bound desc, rate desc, rule desc) = 1)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, few_words or repetition base_failed,
       not (few_words or repetition) and bound <= 0.5 kept, host, rule host_rule, round(rate, 9) host_rate
from f join worst using (host)
"""


@query
def op9_winnowing_decontamination(spark, sf_dir):
    """Words of every document that lie in a window of the benchmark."""
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    rows = decontamination.contamination(documents, benchmark, Workspace(spark, "op9"))
    return rows.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLE["op9_winnowing_decontamination"] = r"""
with d as (
  select row_number() over () r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from documents),
items as (
  select item_id::varchar item,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') ws
  from benchmark),
known as materialized (
  select distinct item, least(len(ws), 10) n, ws[i:i + least(len(ws), 10) - 1] win from items, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) x(i) where len(ws) > 0),
hits as materialized (
  select r, i, d2.n, win from (select r, ws, i, n, ws[i:i + n - 1] win from d, (select distinct n from known) l, unnest(range(1, len(ws) - n + 2)) x(i)) d2
  semi join known using (win)),
found as (select r, count(distinct j) n_hit from (select r, unnest(range(i, i + n)) j from hits) group by r),
its as (select r, count(*) n_items, string_agg(item, ',' order by item) list from (select distinct r, item from hits join known using (win) where item is not null) group by r)
select doc_id, len(ws) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(list, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
from d left join found using (r) left join its using (r)
"""


@query
def op4_token_files(spark, sf_dir):
    """All documents as token files, and what is read back from them."""
    path = Workspace(spark, "op4").path("tokens")
    token_files.write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return token_files.read_documents(token_files.read_segments(spark, path))


@query
def op7_poisson_mixture(spark, sf_dir):
    """All documents, repeated or thinned out to the target weights of their sources, in global hash order."""
    rows = mixing.mixed(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "copy", "copies", "mix_order", "source", "lang", "n_chars", "text")


ORACLE["op7_poisson_mixture"] = f"""
with recursive sizes as (
  select coalesce(source, '') s, sum(coalesce(strlen(text), 0) + 1)::double b from documents group by 1
), total as (select sum(b) b, sum(pow(b, 0.7)) w from sizes),
rates as (select s, pow(sizes.b, 0.7) / total.w * total.b / sizes.b rate from sizes, total),
draws as (select s, rate, greatest(ceil(rate / {mixing.SPLIT}), 1)::int draws from rates),
cdf as (
  select s, 0 k, exp(-rate / draws) p, exp(-rate / draws) c from draws
  union all
  select cdf.s, k + 1, p * (rate / draws) / (k + 1), c + p * (rate / draws) / (k + 1) from cdf join draws using (s) where k < {mixing.TERMS}
), hashed as (
  select d.*, coalesce(d.source, '') s, coalesce(doc_id::varchar, '') || ':17' label from documents d
), drawn as (
  select h.*, n, ('0x' || substr(md5(label || ':' || n), 1, 13))::bigint / 4503599627370496.0::double u
  from hashed h join draws using (s), unnest(range(1, draws + 1)) t(n)
), counted as (
  select doc_id, label, text, lang, source, n_chars, count(cdf.k)::int copies
  from drawn left join cdf on cdf.s = drawn.s and cdf.c <= drawn.u group by all
)
select doc_id, copy::int copy, copies, ('0x' || substr(md5(label || ':order:' || copy), 1, 15))::bigint mix_order, source, lang, n_chars, text
from counted, unnest(range(1, copies + 1)) t(copy)
"""


@query
def op2_template_tree(spark, sf_dir):
    """The verdict on every url, by rule or else by the template of its path."""
    return url_filter.judge(table(spark, sf_dir, "pages"), Workspace(spark, "op2"))


@query
def op5_role_repair(spark, sf_dir):
    """All conversations with the cheapest legal roles, as rendered pieces."""
    return chat.repaired(table(spark, sf_dir, "conversations"), Workspace(spark, "op5"))


@query
def op8_kneser_ney(spark, sf_dir):
    """All documents scored by a model of those that are not held out."""
    documents, workspace = table(spark, sf_dir, "documents"), Workspace(spark, "op8")
    # Pairs of words, all of them: triples took over 7 times the input of disk (see README).
    model = language_model.train(documents.where(~language_model.held_out()), workspace, order=2)
    rows = language_model.score(documents.withColumn("held_out", language_model.held_out()), model, ("doc_id", "held_out"))
    tokens = F.lit(model.levels[1].raw).cast("long").alias("train_tokens")
    return rows.select("doc_id", "held_out", "n_tokens", "n_known", tokens, "base_score", "score", "perplexity")


@query
def op6_order_minhash(spark, sf_dir):
    """The class of near copies of every document."""
    rows = near_duplicates.duplicate_classes(table(spark, sf_dir, "documents"), Workspace(spark, "op6"))
    return rows.select("doc_id", "class_id", "kept")


def _written(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in personal_data.KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ",")


@query
def op3_contextual_personal_data(spark, sf_dir):
    """Personal data of every document: base patterns and what contexts add."""
    rows = personal_data.find(table(spark, sf_dir, "documents"), Workspace(spark, "op3"))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{personal_data.KINDS[kind]}")

    return rows.select("doc_id", *[count(k) for k in range(4)], F.sha2(_written("base"), 256).alias("base_sha256"), _written("spans").alias("spans"))


@query
def op11_exact_copies(spark, sf_dir):
    """The group of equal texts of every document; of each group the document of greatest id stays."""
    return exact_copies.marked(
        table(spark, sf_dir, "documents"), Workspace(spark, "op11"), keep="greatest", carried={"text_sha256": lambda text: F.sha2(text.cast("binary"), 256)}
    )


ORACLE["op11_exact_copies"] = """
with t as (
  select row_number() over () r, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') norm from documents),
g as (select *, count(*) over (partition by norm) group_size, first_value(doc_id) over w keep_id, row_number() over w place from t
      window w as (partition by norm order by doc_id desc nulls last, r rows between unbounded preceding and unbounded following))
select doc_id, keep_id, group_size, place = 1 kept, sha256(norm) text_sha256 from g
"""


@query
def op12_embedding_whitening(spark, sf_dir):
    """Every usable vector, whitened, on the eight components of greatest variance."""
    return whitening.whitened_rows(table(spark, sf_dir, "embeddings"), Workspace(spark, "op12"))


@query
def op13_merkle_manifest(spark, sf_dir):
    """Leaf, roots and proof of every document; every seventh id is checked with a length that is one too great."""
    documents = table(spark, sf_dir, "documents")
    fields = {c: F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")}
    longer = fields | {"n_chars": F.col("n_chars").cast("decimal(20,0)") + 1}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    claimed = F.when(tampered, merkle.leaf(list(longer.values())))
    found = merkle.checked(merkle.leaves(documents, list(fields.values()), "lang", "doc_id", claimed), Workspace(spark, "op13"))
    return found.withColumnRenamed("id", "doc_id")


#: DuckDB has no CRC-32: its 8 steps for each byte, on the reversed polynomial 0xEDB88320.
_CRC32 = """xor(4294967295, list_reduce(
  flatten(list_transform(string_split({0}, ''), lambda c: [ord(c)::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, e: case when e >= 0 then xor(a, e) else xor(a >> 1, 3988292384 * (a & 1)) end, 4294967295::bigint))"""
_FIELD = "coalesce(strlen({0}::varchar)::varchar || ':' || {0}::varchar, '-')"

ORACLE["op13_merkle_manifest"] = rf"""
with recursive d as (
  select *, coalesce('=' || lang, '') tree, {_CRC32.format("doc_id::varchar")} % 7 = 0 odd from documents),
h as (
  select doc_id, tree, sha256(a || b || c || n || t) leaf, case when odd then sha256(a || b || c || n1 || t) end claimed
  from (select *, {_FIELD.format("doc_id")} a, {_FIELD.format("source")} b, {_FIELD.format("lang")} c, {_FIELD.format("n_chars")} n,
               {_FIELD.format("(n_chars + 1)")} n1, {_FIELD.format("text")} t from d)),
ranked as (select *, row_number() over (order by tree, doc_id nulls first, leaf) r,
                  row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 place from h),
levels as (
  select tree, 0 lvl, list(leaf order by place) l from ranked group by tree
  union all
  select tree, lvl + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) from levels where len(l) > 1),
roots as (select tree, l[1] subroot, row_number() over (order by tree) - 1 place from levels where len(l) = 1),
tops as (
  select 100 lvl, list(subroot order by place) l from roots
  union all
  select lvl + 1, list_transform(range(0, (len(l) + 1) // 2), lambda i: sha256(l[2 * i + 1] || coalesce(l[2 * i + 2], ''))) from tops where len(l) > 1),
steps as (
  select r, lvl, place >> lvl pos, l from ranked join levels using (tree) where len(l) > 1
  union all
  select r, lvl, roots.place >> (lvl - 100) pos, l from ranked join roots using (tree), tops where len(l) > 1),
sides as (select r, lvl, case when l[xor(pos, 1) + 1] is null then 'A' when pos % 2 = 1 then 'L' else 'R' end side, coalesce(l[xor(pos, 1) + 1], '') other from steps),
paths as (select r, list(side || other order by lvl) path, string_agg(other, '' order by lvl) others from sides group by r),
proven as (
  select doc_id, leaf, subroot, (select l[1] from tops where len(l) = 1) root, sha256(coalesce(others, '')) proof_sha256,
         list_reduce(list_prepend(coalesce(claimed, leaf), coalesce(path, [])),
                     lambda own, e: case e[1] when 'A' then sha256(own) when 'L' then sha256(e[2:] || own) else sha256(own || e[2:]) end) folded_root
  from ranked left join paths using (r) join roots using (tree))
select *, folded_root = root verified from proven
"""
