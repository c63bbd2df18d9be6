"""The named queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensa.llm import chat, decontamination, divergence, html_wrappers, language, licenses, merkle, mixing, ngram_join, periodic, pieces, token_files, toxicity
from propensa.llm.tables import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


# Both of its turns consist of another template's control strings.
PROBE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.createDataFrame([(-1, 0, "user", PROBE), (-1, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    turns = chat.format_turns(rows, TOKENIZER)
    return chat.conversation_digests(chat.read_turns(turns, TOKENIZER))


OP1_SQL = r"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all values (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), counted as (
  select *, length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text, '<\\*/?s>|\[\\*/?INST\]')) as chars from turns
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  (length('<s>') + sum(chars + length('[INST][/INST]</s>')))::bigint as formatted_chars
from counted group by conv_id
"""


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_files.write(read(spark, sf_dir, "documents"), TOKENIZER)
    return token_files.read_back(spark, files)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html_wrappers.extract(read(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return scored.select("doc_id", language.held_out(scored.doc_id).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.sized(read(spark, sf_dir, "documents")).drop("text", "lang", "n_chars")
    return mixing.trained(mixing.assign(rows)).select(
        "doc_id", "size", "source_size", "target", "taken", "first_position", "last_position", "first_word")


OP5_SQL = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size
  from documents
), sums as (
  select source, sum(size)::bigint as source_size,
    ((row_number() over (order by source nulls last) - 1) % 3 + 1)::int as turn,
    [5.0, 2.0, 1.0][turn]::double as weight, [1.0, 0.5, 1.5][turn]::double as start, [1.0, 1.5, 0.5][turn]::double as "end"
  from docs group by source
), running as (
  select *, coalesce(source, '') as tie, source is null as last,
    sum(source_size) over () as everything,
    coalesce(sum(source_size) over (order by source_size / weight, source nulls first
      rows between unbounded preceding and 1 preceding), 0) as stopped,
    sum(weight) over (order by source_size / weight, source nulls first
      rows between current row and unbounded following) as rest
  from sums
), levels as (
  select *, (everything * 1.5::double - stopped * 2) / rest as level from running
), level as (
  select (list(level order by source_size / weight, source nulls first)
    filter (where level * weight <= source_size * 2))[1] as level from levels
), targets as (
  select s.source, s.source_size, s.start, s."end",
    least(s.source_size * 2.0::double, coalesce(l.level * s.weight, s.source_size * 2.0::double)) as target
  from sums s cross join level l
), placed as (
  select row_number() over () as r, d.doc_id, d.source, d.size, t.source_size, t.target, t.start, t."end",
    case when t.source_size > 0 then floor(t.target / t.source_size)::bigint else 0 end as passes,
    coalesce(sum(d.size) over (partition by d.source order by md5(coalesce(d.doc_id::varchar, '')), d.doc_id nulls first, d.size
      rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from docs d join targets t on d.source is not distinct from t.source
), copy as (
  select *, unnest(range(passes + case when before + size / 2.0::double <= target - passes * source_size then 1 else 0 end)) as nth
  from placed where size > 0
), share as (
  select *, least(1.0::double, (before + nth * source_size + size / 2.0::double) / target) as share, "end" - start as slope from copy
), positioned as (
  select *, case when slope = 0 then share / start else (sqrt(start * start + 2 * slope * share) - start) / slope end as position from share
), streamed as (
  select *, sum(size) over (order by position, doc_id nulls first, source nulls first, before) - size as ahead from positioned
), mixed as (
  select r, sum(size)::bigint as taken, min(position) as first_position, max(position) as last_position, min(ahead)::bigint as first_word
  from streamed group by r
)
select doc_id, size, source_size, target, coalesce(taken, 0)::bigint as taken, first_position, last_position, first_word
from placed left join mixed using (r)
"""


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


# Items of fewer than five words have one shingle, all their words. A window starts at a shingle of
# the item or ends with the text.
OP6_SQL = r"""
with item_words as (
  select item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from benchmark where text is not null
), item as (
  select item_id, least(5, len(words)) as width,
    [array_to_string(words[i:i + least(5, len(words)) - 1], ' ') for i in range(1, len(words) - least(5, len(words)) + 2)] as bag
  from item_words where len(words) > 0
), item_shingle as (
  select item_id, width, len(bag) as size, shingle, count(*) as n
  from (select item_id, width, bag, unnest(bag) as shingle from item) group by all
), doc as (
  select doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from documents where text is not null
), doc_shingle as (
  select doc_id, width, len(words) - width + 1 as n, unnest(range(len(words) - width + 1)) as pos,
    unnest([array_to_string(words[i:i + width - 1], ' ') for i in range(1, len(words) - width + 2)]) as shingle
  from doc, (select distinct width from item) where len(words) >= width
), hit as (
  select d.doc_id, i.item_id, i.size, least(i.size, d.n) as held, d.n, d.pos, d.shingle, i.n as times
  from doc_shingle d join item_shingle i using (width, shingle)
), start as (
  select distinct doc_id, item_id, size, held, least(pos, n - held) as start from hit
), common as (
  select doc_id, item_id, size, held, start, shingle, least(count(*), any_value(times)) as shared
  from start s join hit h using (doc_id, item_id, size, held) where h.pos between s.start and s.start + s.held - 1
  group by all
), sums as (
  select doc_id, item_id, start, sum(shared) as shared, held + size as total from common group by doc_id, item_id, start, held, size
), scored as (
  select doc_id, item_id, start, shared::double / (total - shared) as similarity from sums
)
select doc_id, item_id, max(similarity) as similarity, arg_min(start, (-similarity, start))::int as start
from scored where similarity * 5 >= 4 group by doc_id, item_id
"""


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    scored = language.predict(docs.select("doc_id", "text"), language.fit(docs))
    return scored.select("doc_id", language.held_out(scored.doc_id).alias("held_out"), "lang_pred", "score")


def op8_quality_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.judge(read(spark, sf_dir, "documents")).drop("class_distance", "word_distance")


# Character classes and common words by language, as the operator's constants say.
OP8_SQL = r"""
with doc as (
  select row_number() over () as r, doc_id, coalesce(text, '') as text, coalesce(lang, '') as lang from documents
), worded as (
  select *, regexp_extract_all(text, '[^ 	-
]+') as words from doc
), base as (
  select *, len(words)::bigint as n_words, coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::bigint as word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::bigint as n_symbols,
    length(text) as n, length(regexp_replace(text, '\P{Lu}+', '', 'g')) as up, length(regexp_replace(text, '\P{L}+', '', 'g')) as letter,
    length(regexp_replace(text, '\P{N}+', '', 'g')) as digit, length(regexp_replace(text, '\P{P}+', '', 'g')) as mark,
    length(regexp_replace(text, '[^ 	-
]+', '', 'g')) as space
  from worded
), line as (
  select r, count(*) - count(distinct line) as n_dup_lines from (select r, unnest(string_split(text, chr(10))) as line from doc)
  where regexp_matches(line, '[^ 	-
]') group by r
), part as (
  select r, unnest(range(len(words) - 2)) as i, unnest(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) as three from worded where len(words) > 2
), twice as (
  select r, i from part qualify count(*) over (partition by r, three) > 1
), covered as (
  select r, count(distinct i + j) as n_repeat_words from twice, (select unnest([0, 1, 2]) as j) group by r
), class as (
  select r, lang, pos, n from (select r, lang, unnest([up, letter - up, digit, mark, space, n - letter - digit - mark - space]) as n, unnest([0, 1, 2, 3, 4, 5]) as pos from base)
), class_reference as (
  select lang, pos, sum(n) / sum(sum(n)) over (partition by lang) as q from class group by lang, pos
), word as (
  select r, lang, lower(rtrim(w, '.,;:!?')) as w from (select r, lang, unnest(words) as w from worded)
), counted as (
  select lang, w, count(*) as n from word group by lang, w
), total as (
  select lang, sum(n) as n from counted group by lang having sum(n) >= @LEAST@
), top as (
  select lang, w, n from counted join (select lang from total) using (lang) where w != ''
  qualify row_number() over (partition by lang order by n desc, w) <= @COMMON@
), word_reference as (
  select lang, w, top.n / total.n as q from top join total using (lang)
  union all select lang, null, 1 - sum(top.n) / total.n from top join total using (lang) group by lang, total.n
), word_share as (
  select b.r, ref.lang, ref.w, ref.q, coalesce(h.n, 0) / b.n_words as p
  from base b join word_reference ref using (lang) left join (select r, w, count(*) as n from word group by r, w) h on h.r = b.r and h.w = ref.w
  where ref.w is not null and b.n_words >= @JUDGED@
), word_all as (
  select r, p, q from word_share
  union all select s.r, 1 - sum(s.p), any_value(o.q) from word_share s join (select lang, q from word_reference where w is null) o using (lang) group by s.r
), word_far as (
  select r, sqrt(greatest(0, sum(case when p > 1e-12 then p * log2(p / ((p + q) / 2)) else 0 end + case when q > 1e-12 then q * log2(q / ((p + q) / 2)) else 0 end) / 2)) as d
  from word_all group by r
), class_share as (
  select c.r, case when b.n > 0 then c.n / b.n else 0 end as p, f.q
  from class c join base b using (r) join class_reference f on f.lang = c.lang and f.pos = c.pos join total t on t.lang = c.lang
), class_far as (
  select r, sqrt(greatest(0, sum(case when p > 0 then p * log2(p / ((p + q) / 2)) else 0 end + case when q > 0 then q * log2(q / ((p + q) / 2)) else 0 end) / 2)) as d
  from class_share group by r
), joined as (
  select b.*, coalesce(l.n_dup_lines, 0)::bigint as n_dup_lines, coalesce(c.n_repeat_words, 0)::bigint as n_repeat_words,
    coalesce(w.d, 0) <= @MOST_WORD@ and coalesce(f.d, 0) <= @MOST_CLASS@ as near
  from base b left join line l using (r) left join covered c using (r) left join word_far w using (r) left join class_far f using (r)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and near as kept
from joined
"""
for _name, _value in (("LEAST", divergence.LEAST_REFERENCE_WORDS), ("COMMON", divergence.COMMON_WORDS), ("JUDGED", divergence.LEAST_HISTOGRAM_WORDS),
                      ("MOST_WORD", divergence.MOST_WORD_DISTANCE), ("MOST_CLASS", divergence.MOST_CLASS_DISTANCE)):
    OP8_SQL = OP8_SQL.replace(f"@{_name}@", str(_value))


def op9_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(read(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.best(licenses.scan(read(spark, sf_dir, "documents")))
    return found.select("doc_id", "best.license", F.coalesce("best.dice", F.lit(0.0)).alias("dice"),
                        F.size("matches").cast("long").alias("n_matches"), F.size("passages").cast("long").alias("n_passages"))


def _values() -> str:
    rows = [(name, text) for name, texts in licenses.TEMPLATES.items() for text in texts]
    return ", ".join(f"""({i}, '{name}', '{text.replace("'", "''")}')""" for i, (name, text) in enumerate(rows))


OP10_SQL = r"""
with template as (
  select nth, license, len(words) - 1 as size, unnest(list_transform(list_zip(words[:-2], words[2:]), lambda p: p[1] || ' ' || p[2])) as bigram
  from (select *, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from (values @VALUES@) t(nth, license, text))
), bag as (
  select nth, license, size, bigram, count(*) as times from template group by all
), row as (
  select row_number() over () as r, doc_id, text from documents
), unit as (
  select distinct r, unnest(list_concat(string_split(text, chr(10)), regexp_split_to_array(text, '\n(?:[ \t\r\f\x0B]*\n)+'))) as unit from row
), worded as (
  select row_number() over () as u, r, regexp_extract_all(lower(unit), '[\p{L}\p{N}]+') as words from unit
), found as (
  select u, r, len(words) - 1 as size, unnest(list_transform(list_zip(words[:-2], words[2:]), lambda p: p[1] || ' ' || p[2])) as bigram from worded
), counted as (
  select u, r, size, bigram, count(*) as times from found group by all
), score as (
  select c.u, c.r, b.nth, b.license, sum(least(c.times, b.times)) * 2 / (c.size + b.size)::double as dice,
    sum(least(c.times, b.times)) * 2 * 20 >= (c.size + b.size) * 17 as enough
  from counted c join bag b using (bigram) group by c.u, c.r, c.size, b.nth, b.license, b.size
), matched as (
  select r, u, max((dice, -nth, license)) as best from score where enough group by r, u
), whole as (
  select r, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') as words from row where text is not null
), gram as (
  select r, len(words) - 1 as n, unnest(range(len(words) - 1)) as pos,
    unnest(list_transform(list_zip(words[:-2], words[2:]), lambda p: p[1] || ' ' || p[2])) as bigram
  from whole where len(words) > 1
), hit as (
  select r, nth, license, size, least(size, n) as held, n, pos, bigram, times from gram join bag using (bigram)
), start as (
  select distinct r, nth, held, least(pos, n - held) as start from hit
), shared as (
  select r, nth, license, start, held, size, bigram, least(count(*), any_value(times)) as shared
  from start s join hit h using (r, nth, held) where h.pos between s.start and s.start + held - 1 group by all
), window_score as (
  select r, nth, license, sum(shared) * 2 / (held + size)::double as dice, sum(shared) * 2 * 20 >= (held + size) * 17 as enough
  from shared group by r, nth, license, start, held, size
), passage as (
  select r, nth, max((dice, -nth, license)) as best from window_score where enough group by r, nth
), top as (
  select r, max(best) as top, count(*) filter (unit) as n_matches, count(*) filter (not unit) as n_passages
  from (select r, best, true as unit from matched union all select r, best, false from passage) group by r
)
select doc_id, any_value(m.top[3]) as license, coalesce(any_value(m.top[1]), 0.0)::double as dice,
  coalesce(any_value(n_matches), 0)::bigint as n_matches, coalesce(any_value(n_passages), 0)::bigint as n_passages
from row left join top m using (r) group by r, doc_id
""".replace("@VALUES@", _values())


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = pieces.encode(read(spark, sf_dir, "documents").select("doc_id", "text"), PIECES)
    coded = ids.withColumn("ids_sha256", F.sha2("ids", 256))
    decoded = pieces.decode(coded, PIECES)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(read(spark, sf_dir, "documents"))).withColumnRenamed("id", "doc_id")


# The unsigned CRC-32 of a decimal number, a bit at a time.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(@ID@::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _merkle_sql(levels: int = 6, top_levels: int = 3) -> str:
    """Levels one by one: enough for 8 ** 6 rows of a language and 8 ** 3 languages."""
    written = lambda text: "||".join(
        f"coalesce(strlen({v}::varchar) || ':' || {v}::varchar, '-')" for v in ("doc_id", "source", "lang", "n_chars", text))
    parts = [f"""doc as (
  select *, sha256({written("text")}) as leaf, sha256({written("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) as changed,
    {_CRC32.replace("@ID@", "doc_id")} as crc, dense_rank() over (order by lang nulls first) - 1 as t from documents
), path0 as (
  select row_number() over () as r, doc_id, leaf, t, row_number() over (partition by t order by doc_id nulls first, leaf) - 1 as idx,
    case when crc % 3 = 0 then changed else leaf end as node, '' as proof from doc
), n0 as (select t, idx, leaf as h from path0)"""]

    def climb(name: str, count: int) -> None:
        for k in range(count):
            parts.append(f"""{name}{k}_many as (select t from {name}{k} group by t having count(*) > 1
), {name}{k + 1} as (
  select t, idx // 8 as idx, sha256(string_agg(h, '' order by idx)) as h from {name}{k} where t in (from {name}{k}_many) group by t, idx // 8
)""")

    def fold(path: str, name: str, count: int) -> None:
        for k in range(count):
            parts.append(f"""{path}{k + 1} as (
  select p.r, any_value(p.doc_id) as doc_id, any_value(p.leaf) as leaf, p.t, p.idx // 8 as idx,
    sha256(string_agg(case when s.idx = p.idx then p.node else s.h end, '' order by s.idx)) as node,
    any_value(p.proof) || coalesce(string_agg(s.h, '' order by s.idx) filter (s.idx != p.idx), '') as proof
  from {path}{k} p join {name}{k} s on s.t = p.t and s.idx // 8 = p.idx // 8 where p.t in (from {name}{k}_many) group by p.r, p.t, p.idx
  union all select r, doc_id, leaf, t, idx, node, proof from {path}{k} where t not in (from {name}{k}_many)
)""")

    climb("n", levels)
    fold("path", "n", levels)
    every = " union all ".join(f"select {k} as k, t, h from n{k}" for k in range(levels + 1))
    parts.append(f"""sub as (select t, arg_max(h, k) as h from ({every}) group by t
), m0 as (select 0 as t, t as idx, h from sub), up0 as (select r, doc_id, leaf, 0 as t, t as idx, node, proof from path{levels})""")
    climb("m", top_levels)
    fold("up", "m", top_levels)
    every = " union all ".join(f"select {k} as k, h from m{k}" for k in range(top_levels + 1))
    return "with " + ", ".join(parts) + f""", top as (select arg_max(h, k) as h from ({every}))
select u.doc_id, u.leaf, sub.h as subroot, top.h as root, sha256(u.proof) as proof_sha256, u.node as folded_root, u.node = top.h as verified
from up{top_levels} u join path0 using (r) join sub on sub.t = path0.t cross join top"""


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse(periodic.find(read(spark, sf_dir, "documents"), plant=True))
    longest = F.array_sort("runs", lambda a, b: F.when(a["length"] != b["length"], F.signum(b["length"] - a["length"]))
                           .when(a["start"] != b["start"], F.signum(a["start"] - b["start"])).otherwise(F.signum(a["period"] - b["period"])).cast("int"))
    line = lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n"))
    best = F.get(longest, F.lit(0))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), "collapsed_sha256")
    return rows.select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                       F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


# Every pair of equal words no further apart than a fourth of the text; stretches of pairs of one distance.
OP13_SQL = r"""
with doc as (
  select row_number() over () as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words, @CRC@ as h from documents
), cut as (
  select *, len(words) as n, (h // 10) % greatest(len(words), 1) as a, 3 + (h // 10) % 8 as parts from doc
), long as (
  select *, 1 + (n - a) // parts as period from cut
), changed as (
  select r, doc_id, n, case when h % 10 = 0 and n > 0
    then list_concat(words[:a], list_transform(range(n - a), lambda i: words[a + i % period + 1])) else words end as words from long
), word as (
  select r, n, unnest(words) as w, unnest(range(n)) as i from changed
), pair as (
  select x.r, x.i, x.i - y.i as p from word x join word y on x.r = y.r and x.w = y.w and x.i > y.i and 4 * (x.i - y.i) <= x.n
), placed as (
  select r, p, i, i - row_number() over (partition by r, p order by i) as stretch from pair
), whole as (
  select r, p, min(i) - p as start, count(*) + p as length from placed group by r, p, stretch having count(*) >= greatest(3 * p, 6 - p)
), run as (
  select r, start, length, min(p) as period from whole group by r, start, length
), listed as (
  select r, count(*) as n_runs, arg_min({'start': start, 'length': length, 'period': period}, (-length, start, period)) as best,
    string_agg(start || ',' || length || ',' || period || chr(10), '' order by start, period) as runs from run group by r
), dropped as (
  select distinct r, unnest(range(start + period, start + length)) as i from run
), kept as (
  select r, string_agg(w, ' ' order by i) as words from word anti join dropped using (r, i) group by r
)
select doc_id, coalesce(n_runs, 0) as n_runs, best.start as start, best.length as length, best.period as period,
  1000 * best.length // best.period as exponent_milli, sha256(coalesce(runs, '')) as runs_sha256, sha256(coalesce(k.words, '')) as collapsed_sha256
from changed left join listed using (r) left join kept k using (r)
""".replace("@CRC@", _CRC32.replace("@ID@", "doc_id"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_format": op1_chat_format,
    "op2_token_files": op2_token_files,
    "op3_html_text": op3_html_text,
    "op4_toxicity": op4_toxicity,
    "op5_mix_sources": op5_mix_sources,
    "op6_decontaminate": op6_decontaminate,
    "op7_language_id": op7_language_id,
    "op8_quality_divergence": op8_quality_divergence,
    "op9_ngram_jaccard_join": op9_ngram_jaccard_join,
    "op10_license_scan": op10_license_scan,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_periodic_runs": op13_periodic_runs,
}
SQL: dict[str, str] = {
    "op1_chat_format": OP1_SQL,
    "op5_mix_sources": OP5_SQL,
    "op6_decontaminate": OP6_SQL,
    "op8_quality_divergence": OP8_SQL,
    "op10_license_scan": OP10_SQL,
    "op12_merkle_manifest": _merkle_sql(),
    "op13_periodic_runs": OP13_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
