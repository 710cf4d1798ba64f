"""SQL of the registered queries for another engine."""

from __future__ import annotations

from plumbline.llm import licences

_W = r"'[^\x20\x09-\x0D]+'"

QUALITY = rf"""
with d as (select row_number() over () as r, doc_id, coalesce(text, '') as t from documents),
w as (select *, regexp_extract_all(t, {_W}) as ws,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as ls from d),
g as (select r, i, ws[i] || chr(0) || ws[i + 1] || chr(0) || ws[i + 2] as g
      from (select r, ws, unnest(generate_series(1, len(ws) - 2)) as i from w where len(ws) > 2)),
c as (select r, i, count(*) over (partition by r, g) as n from g),
s as (select r, count(distinct i + k) as n from c, (values (0), (1), (2)) as v(k) where n > 1 group by r),
m as (select w.*, len(ws) as n_words, len(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
             len(t) - len(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
             len(ls) - len(list_distinct(ls)) as n_dup_lines, coalesce(s.n, 0) as n_repeat_words from w left join s using (r)),
b as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from m)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not (base_failed or word_chars < 2 * n_words or word_chars > 15 * n_words or n_symbols > n_words
            or 2 * n_dup_lines > len(ls) or 2 * len(regexp_extract_all(t, '\p{{Lu}}')) > word_chars
            or 3 * len(regexp_extract_all(t, '[^\x20\x09-\x0D]*\p{{L}}[^\x20\x09-\x0D]*')) < n_words) as kept
from b
"""


PHRASES = r"""
with d as (select row_number() over () as r, coalesce(lang, 'und') as lang,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents),
p as (select lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) as p from d),
w as (select row_number() over () as r, lang, regexp_extract_all(p, '[^\x20\x09]+') as ws from p),
i as (select r, lang, ws, unnest(generate_series(1, len(ws))) as i from w),
g as (select lang, k, array_to_string(ws[i:i + k - 1], ' ') as phrase from i, (values (1), (2), (3), (4), (5)) as v(k) where i + k - 1 <= len(ws)),
f as (select lang, k, phrase, count(*) as a from g group by all),
n as (select lang, sum(a)::bigint as n from f where k = 1 group by lang),
c as (select *, string_split(phrase, ' ') as ws from f where k > 1 and a >= 100),
inner_ as (select lang, array_to_string(ws[b:b + s - 1], ' ') as phrase, max(a) as most
           from c, (values (2), (3), (4)) as v(s), (values (1), (2), (3), (4)) as u(b) where s < k and b + s - 1 <= k group by all),
alone as (select c.* from c left join inner_ using (lang, phrase) where most is null or 100 * most < 100 * c.a),
cut as (select lang, phrase, a, ws, k, unnest(generate_series(1, k - 1)) as c from alone),
s as (select cut.lang, cut.phrase, cut.a, c, l.a as l, x.a as r, n,
             ((1000::hugeint * cut.a * n) // (l.a::hugeint * x.a))::bigint as score
      from cut join f l on l.lang = cut.lang and l.phrase = array_to_string(cut.ws[1:c], ' ')
      join f x on x.lang = cut.lang and x.phrase = array_to_string(cut.ws[c + 1:cut.k], ' ') join n on n.lang = cut.lang),
b as (select * from s qualify row_number() over (partition by lang, phrase order by score, c) = 1)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from b qualify rank <= 2000
"""


def _licences() -> str:
    # A pattern here cannot look ahead: "copyright" before licence wording is marked first, then lines that still begin with it go.
    kept = f"regexp_replace(lower(text), 'copyright([^a-z0-9©]*({licences.WORDING})([^a-z]|$))', 'copyrigh' || chr(1) || 't\\1', 'g')"
    form = (f"regexp_replace({kept}, '(?m)^[^a-z0-9\\n]*(copyright([^a-z\\n][^\\n]*)?|(\\(c\\)|©|all rights reserved)[^\\n]*)$', '', 'g')")
    form = f"trim(regexp_replace(replace({form}, 'copyrigh' || chr(1) || 't', 'copyright'), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'))"
    for other, usual in licences.SPELLINGS:
        form = f"replace({form}, '{other}', '{usual}')"
    known = ", ".join(f"('{d}', '{name}')" for d, name in sorted(licences.digests().items()))
    return (f"with h as (select doc_id, sha256({form}) as licence_digest from documents), k(d, licence_id) as (values {known}) "
            "select doc_id, licence_digest, licence_id from h left join k on d = licence_digest")


ORACLE_SQL = {
    "op5_quality": QUALITY,
    "op7_licences": _licences(),
    "op11_phrases": PHRASES,
}
