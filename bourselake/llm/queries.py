"""The registered queries of this subpackage, and SQL that gives the same rows where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language, lines, mixing, neighbours, quality, quotes, repair, simhash, spelling, surrogates, tokencount, windows
from .shared import checkpoint, scratch, table

#: The key of the registered query and the pipeline; real runs pass a secret of their own.
PII_KEY = "not a secret"
#: The vocabulary of the registered query, a file that the driver reads.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Longer documents are favoured, by the binary digits of their number of words."""
    docs = table(spark, sf_dir, "documents")
    favour = F.least(F.length(F.bin(mixing.word_count(F.col("text")))), F.lit(16))
    return mixing.mix(docs, favour=favour).select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.dedup(table(spark, sf_dir, "documents"), text=False)


def op3_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op5_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes.conversations(table(spark, sf_dir, "conversations"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.damaged(table(spark, sf_dir, "documents"))
    return spelling.variants(checkpoint(spelling.vocabulary(words)))


def op12_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.report(repair.damaged(table(spark, sf_dir, "conversations")))


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A new index of all documents, and the documents without its frequent lines."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    index = lines.LineIndex(spark, scratch(spark, "lines"))
    index.insert(docs)
    return index.dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_surrogates": op3_surrogates,
    "op4_language": op4_language,
    "op5_quotes": op5_quotes,
    "op6_simhash": op6_simhash,
    "op7_quality": op7_quality,
    "op8_token_counts": op8_token_counts,
    "op9_neighbours": op9_neighbours,
    "op10_decontaminate": op10_decontaminate,
    "op11_spelling": op11_spelling,
    "op12_repair": op12_repair,
    "op13_lines": op13_lines,
}

#: CRC-32 of the bytes in a list, with the table in column `tab`.
_CRC = "xor(list_reduce(list_prepend(4294967295, {}), lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])), 4294967295)"
_TAB = "t as (select list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, k: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as tab)"

ORACLES: dict[str, str] = {
    "op1_mix_sources": rf"""
        with d as (select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size,
                          (cast(('0x' || substr(md5('{mixing.SEED}|' || doc_id), 1, 13)) as bigint) + 0.5::double) / 4503599627370496::double as u from documents),
             s as (select source, cast(sum(size) as bigint) as size from d group by 1),
             w as (select *, [5.0::double, 2.0::double, 1.0::double][1 + (row_number() over (order by source nulls last) - 1) % 3] as weight, 2.0::double * size as room, 1.5::double * sum(size) over () as share from s),
             o as (select *, row_number() over (order by room / weight, source nulls last) as turn from w),
             l as (select *, (share - coalesce(sum(room) over (order by turn rows between unbounded preceding and 1 preceding), 0.0::double)) / sum(weight) over (order by turn rows between current row and unbounded following) as level from o),
             f as (select arg_min(level, turn) as level from l where weight * level <= room),
             t as (select l.source, l.size as source_size, least(coalesce(l.weight * f.level, l.room), l.room) as target from l left join f on true),
             k as (select source, favour, cast(sum(size) as bigint) as size from (select *, least(length(bin(size)), 16) as favour from d) group by 1, 2),
             v as (select k.source, favour, t.target, 2.0::double * coalesce(sum(k.size) over (partition by k.source order by favour desc rows between unbounded preceding and 1 preceding), 0) as done,
                          cast(sum(k.size * favour) over (partition by k.source order by favour desc rows between current row and unbounded following) as double) as rest from k join t on k.source is not distinct from t.source),
             e as (select source, arg_max((target - done) / nullif(rest, 0), favour) filter ((target - done) / nullif(rest, 0) * favour <= 2) as level from v group by 1),
             r as (select d.*, t.source_size, t.target, case when t.source_size > 0 then least(coalesce(e.level * least(length(bin(d.size)), 16), 2.0::double), 2.0::double) else 0.0::double end as rate from d join t on d.source is not distinct from t.source join e on d.source is not distinct from e.source),
             i as (select *, cast(floor(rate) as bigint) as sure, least(greatest(rate - floor(rate), 1e-12::double), 1 - 1e-12::double) as p from r),
             p as (select *, target - sum(sure * size) over (partition by source) as rest, coalesce(sum(size) over (partition by source order by u / (1 - u) / (p / (1 - p)), doc_id rows between unbounded preceding and 1 preceding), 0) as ahead from i)
        select doc_id, size, source_size, target, source, size * least(2, sure + case when ahead + size / 2.0 <= rest then 1 else 0 end) as taken from p
    """,
    "op2_substring_dedup": r"""
        with w as (select doc_id, row_number() over () as r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
             i as (select doc_id, r, w, unnest(range(1, greatest(len(w) - 11, 1))) as i from w),
             g as (select doc_id, r, i, array_to_string(w[i:i + 12], ' ') as g from i),
             m as (select g, min(doc_id) as first from g group by 1 having min(doc_id) < max(doc_id)),
             h as (select g.r, g.i from g join m on g.g = m.g where g.doc_id > m.first),
             c as (select distinct r, i + k as p from h, (select unnest(range(13)) as k)),
             x as (select r, unnest(w) as x, unnest(range(1, len(w) + 1)) as p from w),
             k as (select x.r, string_agg(x.x, ' ' order by x.p) as kept from x left join c on c.r = x.r and c.p = x.p where c.p is null group by 1),
             n as (select r, count(*) as n from c group by 1)
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from w left join k on k.r = w.r left join n on n.r = w.r
    """,
    "op10_decontaminate": r"""
        with t as (select 0 as item, doc_id as id, row_number() over () as r, text from documents union all select 1, item_id, row_number() over (), text from benchmark),
             w as (select item, id, r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from t),
             s as (select r, id, w, least(len(w), 10) as n from w where item = 1 and len(w) > 0),
             b as (select r, cast(id as varchar) as id, n, i as j, array_to_string(w[i:i + n - 1], ' ') as g from (select *, unnest(range(1, len(w) - n + 2)) as i from s)),
             z as (select distinct n from b),
             g as (select r, n, i, array_to_string(w[i:i + n - 1], ' ') as g from (select w.r, w.w, z.n, unnest(range(1, greatest(len(w) - z.n + 2, 1))) as i from w, z where w.item = 0)),
             h as (select g.r, g.i, g.n, b.id, b.r as of, b.j from g join b on b.n = g.n and b.g = g.g),
             p as (select distinct r, unnest(range(i, i + n)) as p from (select distinct r, i, n from h)),
             c as (select r, count(*) as n_hit from p group by 1),
             a as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, id from h) group by 1),
             m as (select r, id, min(i) - 1 as start, count(*) + n - 1 as length from (select *, i - row_number() over (partition by r, of, n, i - j order by i) as run from h) group by r, of, id, n, i - j, run),
             l as (select * from m qualify row_number() over (partition by r order by length desc, start, id) = 1)
        select w.id as doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated,
               coalesce(l.length, 0) as longest_match, l.start as longest_start, l.id as longest_item
        from w left join c on c.r = w.r left join a on a.r = w.r left join l on l.r = w.r where w.item = 0
    """,
    "op11_spelling": rf"""
        with recursive {_TAB},
             r as (select coalesce(doc_id::varchar, '') as doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) as run from documents),
             l as (select doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run, count(*) as n from r where length(run) >= 6 group by all),
             b as (select run, n, tab, flatten(list_transform(string_split(doc_id || ':' || run, ''), lambda x: case when unicode(x) < 128 then [unicode(x)] else [192 + (unicode(x) >> 6), 128 + (unicode(x) & 63)] end)) as bytes from l, t),
             h as (select run, n, {_CRC.format("bytes")} as h from b),
             w as (select case when h % 199 = 0 then substr(run, 1, (h % length(run))::integer) || substr(run, (h % length(run))::integer + 2) else run end as word, n from h),
             v as (select word, sum(n)::bigint as n from w where length(word) >= 6 group by 1 having sum(n) >= 5),
             d as (select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as cut from (select *, unnest(range(1, length(word) + 1)) as i from v)),
             p as (select a.word, b.word as near, b.n as near_n from d a join d b on a.i = b.i and a.cut = b.cut and a.word <> b.word
                   union all select d.word, v.word, v.n from (select distinct word, cut from d) d join v on d.cut = v.word
                   union all select v.word, d.word, d.n from (select distinct word, n, cut from d) d join v on d.cut = v.word),
             s as (select word, count(*) as n_near, max(near_n) as top from p group by 1),
             f as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when top >= 5 * v.n then (select min(near) from p where p.word = v.word and p.near_n = top) end as form, case when top >= 5 * v.n then top end as form_n from v left join s on s.word = v.word),
             g as (select word, word as at, form as next from f union all select g.word, f.word, f.form from g join f on f.word = g.next)
        select f.word, f.form, g.at as root, f.n, n_near, form_n from f join g on g.word = f.word and g.next is null
    """,
    "op12_repair": rf"""
        with recursive {_TAB},
             k as (select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, tab, list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: unicode(x)) as bytes from conversations, t),
             f as (select conv_id, turn, role, text, {_CRC.format("bytes")} % 20 as f from k),
             d as (select conv_id, turn, case when f = 4 then 'user' else role end as role, case when f = 1 then '' when f = 2 then translate(text, '.!?', '') else text end as text, unnest(range(case when f = 3 then 2 else 1 end)) from f where f <> 0),
             o as (select conv_id, turn, role, text, row_number() over (partition by conv_id order by turn nulls first, role, text) as i, substr(role, 1, 1) as r,
                          regexp_replace(text, '[ 	-
]+$', '') as e from d),
             s as (select *, case when e = '' then 'b' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd' when e not like '%.' and e not like '%!' and e not like '%?' then 't' else '' end as fault, lag(r) over (partition by conv_id order by i) || r as pair from o),
             c as (select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate, count(*) filter (fault = 't') as truncated,
                          count(*) filter (pair not in ('su', 'ua', 'au')) as illegal from s group by 1),
             p as (select conv_id, n as i, [{{c: 0, a: ''}}, {{c: 10, a: 'II'}}, {{c: 5, a: 'I'}}, {{c: 0, a: ''}}] as b from c
                   union all
                   select p.conv_id, p.i - 1, (select list_transform([1, 2, 3, 4], lambda x: list_sort([w[x], {{c: 5 + w[nx[x]].c, a: 'I' || w[nx[x]].a}}, {{c: 10 + w[nx[nx[x]]].c, a: 'II' || w[nx[nx[x]]].a}}])[1]) from (select [3, 3, 4, 3] as nx, list_transform([1, 2, 3, 4], lambda x: list_sort([
                              {{c: 2 + p.b[x].c, a: 'D' || p.b[x].a}},
                              {{c: case when s.fault in ('b', 'd') then 1000000000 else 1 + case when s.fault = 't' then 5 else 0 end end + p.b[[3, 3, 4, 3][x]].c, a: 'R' || p.b[[3, 3, 4, 3][x]].a}},
                              {{c: case when s.fault in ('b', 'd') or s.r <> ['u', 'u', 'a', 'u'][x] then 1000000000 else case when s.fault = 't' then 5 else 0 end end + p.b[[3, 3, 4, 3][x]].c, a: 'K' || p.b[[3, 3, 4, 3][x]].a}},
                              {{c: case when s.fault in ('b', 'd') or s.r <> 's' or x <> 1 then 1000000000 else case when s.fault = 't' then 5 else 0 end end + p.b[2].c, a: 'K' || p.b[2].a}}])[1]) as w))
                   from p join s on s.conv_id is not distinct from p.conv_id and s.i = p.i),
             z as (select conv_id, b[1].c as cost, b[1].a as audit from p where i = 0),
             y as (select conv_id, audit, 1 as k, 1 as i, 1 as x, cast(null as varchar) as text from z
                   union all
                   select y.conv_id, audit, k + 1, case when l = 'I' then y.i else y.i + 1 end, to_x, case when l = 'D' then y.text else concat_ws(chr(10), y.text, case l when 'I' then ['system', 'user', 'assistant'][to_x - 1] || ':' when 'R' then ['system', 'user', 'assistant'][to_x - 1] || ':' || s.text when 'K' then s.role || ':' || s.text end) end
                   from (select *, substr(audit, k, 1) as l from y where k <= length(audit)) y left join s on s.conv_id is not distinct from y.conv_id and s.i = y.i,
                        lateral (select case when l = 'D' then x when l = 'K' and x = 1 and s.r = 's' then 2 else [3, 3, 4, 3][x] end as to_x) g)
        select a.conv_id, coalesce(c.gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(z.cost, 0)::bigint as cost, coalesce(z.audit, '') as audit, sha256(coalesce(y.text, '')) as repaired_sha256
        from (select distinct conv_id from conversations) a left join c on c.conv_id is not distinct from a.conv_id left join z on z.conv_id is not distinct from a.conv_id left join y on y.conv_id is not distinct from a.conv_id and y.k = length(z.audit) + 1
    """,
    "op13_lines": r"""
        with d as (select doc_id, row_number() over () as r, string_split(coalesce(text, ''), chr(10)) as lines from documents),
             l as (select doc_id, r, i, lines[i] as line, translate(regexp_replace(lines[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k from (select *, unnest(range(1, len(lines) + 1)) as i from d)),
             f as (select k, max(doc_id) as keeper from l where length(k) >= 20 group by 1 having count(distinct doc_id) + max(case when doc_id is null then 1 else 0 end) >= 3),
             m as (select l.*, f.k is not null and l.doc_id is distinct from f.keeper as gone from l left join f on l.k = f.k)
        select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped, sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256 from m group by doc_id, r
    """,
}
