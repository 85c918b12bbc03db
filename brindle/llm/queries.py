"""The registered queries of the ten operators and, where SQL can express them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm import (
    bpe, chat, decontaminate, divergence, fill_middle, language, licenses, line_dedup, line_rules, parity, perplexity,
    suffix_dedup, toxicity,
)
from brindle.llm.tables import remainder, table


def tokenizer_path(name: str) -> str:
    """A file of the installed public tokenizers."""
    from public_tokenizers import path

    return path(name)


Query = Callable[[SparkSession, str], DataFrame]


def op1_licenses(spark: SparkSession, base: str) -> DataFrame:
    return licenses.scan(table(spark, base, "documents"))


def op2_toxicity(spark: SparkSession, base: str) -> DataFrame:
    documents = table(spark, base, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    labelled = documents.select("doc_id", "text").join(
        table(spark, base, "labels").select("doc_id", "toxic"), "doc_id"
    )
    weights = toxicity.fit(labelled.where(~held_out), label="toxic")
    return toxicity.score(documents, weights).select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def trusted_keys(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "labels").where("quality = 1").select("doc_id")


def op3_quality(spark: SparkSession, base: str) -> DataFrame:
    return perplexity.classify(table(spark, base, "documents"), trusted_keys(spark, base))


def op4_line_rules(spark: SparkSession, base: str) -> DataFrame:
    cleaned = line_rules.clean(table(spark, base, "documents"))
    return cleaned.withColumn("clean_sha256", F.sha2("clean_text", 256)).drop("clean_text")


def op5_line_dedup(spark: SparkSession, base: str) -> DataFrame:
    documents = table(spark, base, "documents").select("doc_id", "text")
    kept = line_dedup.without_lines(documents, line_dedup.repeated_lines(documents))
    return kept.select(
        "doc_id",
        F.size("removed").cast("bigint").alias("n_removed"),
        F.array_join("removed", ",").alias("removed_lines"),
        F.sha2("text", 256).alias("text_sha256"),
    )


def op6_ngram_jaccard(spark: SparkSession, base: str) -> DataFrame:
    return parity.near_duplicates(table(spark, base, "documents"))


def op7_language(spark: SparkSession, base: str) -> DataFrame:
    documents = table(spark, base, "documents")
    held_out = F.coalesce(remainder(F.col("doc_id"), 4) == 2, F.lit(False))
    net = language.fit(documents.where(~held_out))
    return language.predict(documents, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op8_bpe(spark: SparkSession, base: str) -> DataFrame:
    encoded = bpe.encode(table(spark, base, "documents"), tokenizer_path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", "n_tokens", bpe.ids_sha256(F.col("ids")).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op9_chat(spark: SparkSession, base: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    fixed = spark.range(1).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.explode(
            F.array(
                F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role"), F.lit(said).alias("text")),
                F.struct(F.lit(1).cast("bigint").alias("turn"), F.lit("assistant").alias("role"), F.lit(said).alias("text")),
            )
        ).alias("t"),
    ).select("conv_id", "t.*")
    rows = table(spark, base, "conversations").select("conv_id", "turn", "role", "text").unionByName(fixed)
    formatted = chat.format_turns(chat.canonical_turns(chat.records_of_turns(rows, mixed=True)))
    back = formatted.select(
        "conv_id",
        "formatted",
        chat.parse_formatted(F.col("formatted")).alias("back"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"),
    )
    said_again = F.array_join(
        F.transform("back", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    return back.select(
        "conv_id",
        F.size("back").cast("bigint").alias("n_turns"),
        F.sha2(said_again, 256).alias("turns_sha256"),
        F.length("learnt").cast("bigint").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


def op10_decontaminate(spark: SparkSession, base: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, base, "documents"), table(spark, base, "benchmark"))


def op11_suffix_dedup(spark: SparkSession, base: str) -> DataFrame:
    left = suffix_dedup.without_repeats(table(spark, base, "documents"))
    size = F.aggregate("removed", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return left.select(
        "doc_id",
        "n_bytes",
        size.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_divergence(spark: SparkSession, base: str) -> DataFrame:
    return divergence.audit(table(spark, base, "documents"))


def op13_fill_middle(spark: SparkSession, base: str) -> DataFrame:
    return fill_middle.digests(fill_middle.fill_in_middle(table(spark, base, "documents")))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_licenses,
        op2_toxicity,
        op3_quality,
        op4_line_rules,
        op5_line_dedup,
        op6_ngram_jaccard,
        op7_language,
        op8_bpe,
        op9_chat,
        op10_decontaminate,
        op11_suffix_dedup,
        op12_divergence,
        op13_fill_middle,
    )
}


def _listed(values: tuple[str, ...]) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


_WORD = r"[^\x20\x09-\x0D]+"
_COUNTED = "+".join(
    f"(length(body) - length(replace(body, '{s}', '')))" for s in line_rules.SYMBOLS
)
_SEPARATED = " + ".join(
    f"(length(body) - length(replace(body, '{s}', ''))) // {len(s)}" for s in line_rules.SEPARATORS
)
_OP4 = rf"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
lines as (
  select r, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) as k
  from docs
),
full_lines as (
  select r, k, line, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as body
  from lines where regexp_matches(line, '{_WORD}')
),
judged as (
  select r, line, k,
         len(regexp_extract_all(body, '{_WORD}')) as n,
         length(regexp_replace(body, '[\x20\x09-\x0D]+', '', 'g')) as chars,
         {_COUNTED} as symbols,
         {_SEPARATED} as separators,
         length(body) - length(regexp_replace(body, '[A-Z]', '', 'g')) as capitals,
         length(body) - length(regexp_replace(body, '[A-Za-z]', '', 'g')) as letters,
         right(body, 1) in ({_listed(line_rules.ENDINGS)})
           or {" or ".join(f"contains(body, '{s}')" for s in line_rules.STOPS)} as ended,
         {" or ".join(f"contains(translate(body, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{p}')" for p in line_rules.PHRASES)} as phrase
  from full_lines
),
failing as (
  select r, k, chars
  from judged
  where not ended or 4 * symbols > n or separators >= 2 or (n >= 5 and 2 * capitals > letters) or phrase
),
failed as (select r, count(*) as gone, sum(chars) as lost from failing group by r),
cleaned as (
  select r, string_agg(line, chr(10) order by k) as clean_text from lines anti join failing using (r, k) group by r
),
copies as (
  select r, sum(c - 1) as dup from (select r, line, count(*) as c from full_lines group by r, line) group by r
),
words as (
  select r, regexp_extract_all(text, '{_WORD}') as w from docs
),
placed as (
  select r, unnest(w) as word, generate_subscripts(w, 1) as i from words
),
windowed as (
  select r, i, case when count(*) over g = 8 then list(word) over g end as win
  from placed window g as (partition by r order by i rows between current row and 7 following)
),
twice as (
  select r, i from (select r, i, count(*) over (partition by r, win) as c from windowed where win is not null) where c > 1
),
repeated as (
  select r, count(distinct i + s.k) as n from twice, range(8) as s(k) group by r
),
base as (
  select d.r, d.doc_id, len(w.w) as n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]+', '', 'g')) as word_chars,
         {"+".join(f"(length(d.text) - length(replace(d.text, '{s}', '')))" for s in line_rules.SYMBOLS)} as n_symbols,
         coalesce(c.dup, 0)::bigint as n_dup_lines,
         coalesce(rep.n, 0)::bigint as n_repeat_words,
         len(string_split(d.text, chr(10))) as n_lines,
         coalesce(f.gone, 0)::bigint as n_lines_removed,
         coalesce(f.lost, 0)::bigint as chars_removed,
         sha256(coalesce(t.clean_text, '')) as clean_sha256
  from docs d join words w using (r) left join cleaned t using (r) left join copies c using (r)
  left join repeated rep using (r) left join failed f using (r)
),
verdict as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed from base
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and 2 * chars_removed <= word_chars as kept,
       n_lines, n_lines_removed, chars_removed, clean_sha256
from verdict
"""

_SAID = "</s>[INST] ok [/INST]"
_ESCAPED = "replace(replace(replace({0}, '%', '%25'), '<', '%3C'), '[', '%5B')"
_OP9 = f"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '{_SAID}' union all select -1, 1, 'assistant', '{_SAID}'
),
joined as (
  select conv_id, count(*) as n_turns,
         string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text) as said,
         coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '') as learnt,
         sum({len(chat.BEGIN) + len(chat.AFTER_ROLE) + len(chat.END)}
             + length(replace({_ESCAPED.format('role')}, chr(10), '%0A'))
             + length({_ESCAPED.format('text')}))::bigint as formatted_chars
  from rows group by conv_id
)
select conv_id, n_turns, sha256(said) as turns_sha256, length(learnt) as loss_chars,
       sha256(learnt) as loss_sha256, formatted_chars
from joined
"""

_OP6 = rf"""
with recursive docs as (
  select row_number() over () as r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') as w
  from documents
),
shingles as (
  select distinct r, array_to_string(w[i : i + 4], ' ') as s
  from (select r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) as i from docs where len(w) > 0)
),
sizes as (select r, count(*) as n from shingles group by r),
common as (
  select a.r as a, b.r as b, count(*) as n
  from shingles a join shingles b on a.s = b.s and a.r < b.r group by a.r, b.r
),
links as (
  select a, b from common join sizes x on x.r = a join sizes y on y.r = b
  where 100 * common.n >= 75 * (x.n + y.n - common.n)
),
edges as (select a, b from links union all select b, a from links),
reach as (
  select r, r as root from docs
  union
  select e.b, reach.root from reach join edges e on e.a = reach.r
)
select d.doc_id, coalesce(s.n, 0) as n_shingles, min(m.doc_id) as component_id
from docs d left join sizes s on s.r = d.r
join reach on reach.r = d.r join docs m on m.r = reach.root
group by d.r, d.doc_id, s.n
"""

_SHARE = "1 + ({scale}::hugeint * ({count} + 2)) // ({total} + 2 * {terms})"


def _share(count: str, total: str, terms: str) -> str:
    return "(" + _SHARE.format(scale=divergence.SCALE, count=count, total=total, terms=terms) + ")"


_OP12 = rf"""
with docs as (
  select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
  from documents
),
words as (select r, lang, source, unnest(w) as term from docs),
counts as (select lang, source, term, count(*) as n, count(distinct r) as docs from words group by all),
known as (
  select lang, term, sum(n)::bigint as total from counts group by lang, term having sum(docs) >= {divergence.LEAST}
),
kept as (select c.lang, c.source, c.term, c.n, k.total from counts c join known k using (lang, term)),
langs as (select lang, count(*) as v, sum(total)::bigint as n_lang from known group by lang),
sums as (select lang, source, sum(n)::bigint as n_group from kept group by lang, source),
groups as (
  select g.lang, g.source, coalesce(s.n_group, 0) as n_group, coalesce(l.v, 0) as v, coalesce(l.n_lang, 0) as n_lang
  from (select distinct lang, source from docs) g left join sums s using (lang, source) left join langs l using (lang)
),
shares as (
  select g.lang, g.source, k.term, coalesce(x.n, 0) as n,
         {_share('coalesce(x.n, 0)', 'g.n_group', 'g.v')}::bigint as p, {_share('k.total', 'g.n_lang', 'g.v')}::bigint as q
  from groups g join known k using (lang) left join kept x on x.lang = g.lang and x.source = g.source and x.term = k.term
),
pairs as (
  select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::bigint as value
  from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all
),
all_pairs as (
  select g.lang, g.source, h.source as item, coalesce(p.value, 0) as value
  from groups g join groups h on g.lang = h.lang and g.source <> h.source
  left join pairs p on p.lang = g.lang and p.source = g.source and p.item = h.source
),
terms as (
  select lang, source, term as item, ((p - q) * (p - q) // (p + q))::bigint as value from shares where n > 0 and p > q
)
select lang, source, 'pair' as part, item, value,
       row_number() over (partition by lang, source order by value desc, item)::int as rank
from all_pairs
union all
select lang, source, 'term', item, value, row_number() over (partition by lang, source order by value desc, item)::int as rank
from terms qualify rank <= {divergence.MOST}
"""

_DRAWN = "('0x' || substr(h, {at}, 8))::ubigint"
_HOLDS = " or ".join(f"contains(body, '{m}')" for m in (fill_middle.PREFIX, fill_middle.SUFFIX, fill_middle.MIDDLE))
_OP13 = f"""
with docs as (
  select doc_id, coalesce(text, '') as body, sha256('1:' || coalesce(doc_id::varchar, '')) as h from documents
),
drawn as (
  select doc_id, body, length(body) as n, {_DRAWN.format(at=1)} as h1, {_DRAWN.format(at=9)} as h2,
         {_DRAWN.format(at=17)} as h3, {_DRAWN.format(at=25)} as h4
  from docs
),
cuts as (
  select *, least(h1 % (n + 1), h2 % (n + 1))::bigint as a, greatest(h1 % (n + 1), h2 % (n + 1))::bigint as b,
         case when n = 0 or {_HOLDS} or h3 % 100 >= {fill_middle.REARRANGED} then 'plain'
              when h4 % 100 < {fill_middle.SPM} then 'spm' else 'psm' end as form
  from drawn
),
parts as (
  select *, substr(body, 1, a) as x, substr(body, a + 1, b - a) as y, substr(body, b + 1) as z from cuts
)
select doc_id, n, form, case when form <> 'plain' then a end as prefix_chars,
       case when form <> 'plain' then b - a end as middle_chars,
       sha256(case form when 'plain' then body
              when 'psm' then '<P>' || x || '<S>' || z || '<M>' || y
              else '<S>' || z || '<P>' || x || '<M>' || y end) as output_sha256,
       sha256(body) as restored_sha256
from parts
"""

ORACLE: dict[str, str] = {
    "op4_line_rules": _OP4,
    "op6_ngram_jaccard": _OP6,
    "op9_chat": _OP9,
    "op12_divergence": _OP12,
    "op13_fill_middle": _OP13,
}
