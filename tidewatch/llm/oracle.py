"""DuckDB SQL for the queries that SQL can express; the others are tested against brute force."""

from __future__ import annotations

EXACT_DEDUP = r"""
with hashed as (
    select
        doc_id,
        sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
    from documents
)
select
    doc_id,
    min(doc_id) over (partition by text_sha256) as keep_id,
    count(*) over (partition by text_sha256) as group_size,
    doc_id = min(doc_id) over (partition by text_sha256) as kept,
    text_sha256
from hashed
"""

SUBSTRING_DEDUP = r"""
with placed as (
    select doc_id, row_no, unnest(words) as word, generate_subscripts(words, 1) as place
    from (
        select doc_id, row_number() over () as row_no,
            string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') as words
        from documents
    )
),
numbered as (
    select doc_id, row_no, word, row_number() over (partition by row_no order by place) as place
    from placed where word <> ''
),
windows as (
    select doc_id, row_no, place, md5(string_agg(word, ' ') over thirteen) as run,
        count(*) over thirteen as n
    from numbered
    window thirteen as (
        partition by row_no order by place rows between current row and 12 following
    )
),
later as (
    select row_no, place
    from (select *, min(doc_id) over (partition by run) as first_id from windows where n = 13)
    where first_id < doc_id
),
marked as (
    select numbered.*,
        count(later.place) over (
            partition by numbered.row_no order by numbered.place
            rows between 12 preceding and current row
        ) > 0 as gone
    from numbered left join later using (row_no, place)
)
select docs.doc_id,
    count(word) as n_words,
    count(case when gone then 1 end) as n_removed,
    sha256(coalesce(string_agg(case when not gone then word end, ' ' order by place), ''))
        as kept_sha256
from (select doc_id, row_number() over () as row_no from documents) as docs
left join marked using (row_no)
group by docs.row_no, docs.doc_id
"""

HARD_NEGATIVES = """
with usable as (
    select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
        list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
    from (
        select vec_id, label, embedding from embeddings
        where label is not null and embedding is not null
          and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    )
),
pairs as (
    select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as alike,
        cast(list_inner_product(a.v, b.v) as bigint) as score
    from usable as a join usable as b on a.vec_id <> b.vec_id
    where a.vec_id % 100 = 0
),
positives as (
    select anchor_id, other_id as positive_id, score as positive_score
    from pairs where alike
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
),
ranked as (
    select anchor_id, positive_id, positive_score, other_id as negative_id, score as negative_score,
        cast(row_number() over (
            partition by anchor_id, positive_id order by score desc, other_id
        ) as integer) as rank
    from positives join pairs using (anchor_id)
    where not alike and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score
from ranked where rank <= 10
"""

PHRASES = r"""
with pieces as (
    select
        row_number() over () as piece_no,
        lang,
        string_split_regex(piece, '[\x20\x09]+') as words
    from (
        select
            coalesce(lang, 'und') as lang,
            unnest(string_split_regex(
                translate(
                    coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'
                ),
                '[.,;:!?\x0A-\x0D]'
            )) as piece
        from documents
    )
),
placed as (
    select piece_no, lang, unnest(words) as w1, generate_subscripts(words, 1) as place from pieces
),
following as (
    select
        lang, w1,
        lead(w1) over following_words as w2,
        lead(w1, 2) over following_words as w3
    from placed
    where w1 <> ''
    window following_words as (partition by piece_no order by place)
),
f1 as (select lang, w1, count(*) as f from following group by all),
f2 as (select lang, w1, w2, count(*) as f from following where w2 is not null group by all),
f3 as (select lang, w1, w2, w3, count(*) as f from following where w3 is not null group by all),
totals as (select lang, cast(sum(f) as bigint) as n from f1 group by lang),
c3 as (select * from f3 where f >= 10),
longer as (
    select lang, w1, w2, max(f) as longer_f
    from (
        select lang, w1, w2, f from c3 union all select lang, w2 as w1, w3 as w2, f from c3
    )
    group by all
),
cuts as (
    select c.lang, c.w1 || ' ' || c.w2 as phrase, 1 as cut, c.f as a, l.f as l, r.f as r
    from f2 as c
    join f1 as l on l.lang = c.lang and l.w1 = c.w1
    join f1 as r on r.lang = c.lang and r.w1 = c.w2
    left join longer on longer.lang = c.lang and longer.w1 = c.w1 and longer.w2 = c.w2
    where c.f >= 10 and (longer_f is null or 100 * longer_f < 50 * c.f)
    union all
    select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 1, c.f, l.f, r.f
    from c3 as c
    join f1 as l on l.lang = c.lang and l.w1 = c.w1
    join f2 as r on r.lang = c.lang and r.w1 = c.w2 and r.w2 = c.w3
    union all
    select c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, 2, c.f, l.f, r.f
    from c3 as c
    join f2 as l on l.lang = c.lang and l.w1 = c.w1 and l.w2 = c.w2
    join f1 as r on r.lang = c.lang and r.w1 = c.w3
),
scored as (
    select
        *,
        cast(cast(1000000 as hugeint) * a * a // (cast(l as hugeint) * r) as bigint) as score
    from cuts
),
lowest as (select distinct on (lang, phrase) * from scored order by lang, phrase, score, cut),
ranked as (
    select
        *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank
    from lowest
)
select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
"""

ORACLE: dict[str, str] = {
    "op1_exact_dedup": EXACT_DEDUP,
    "op6_substring_dedup": SUBSTRING_DEDUP,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_phrases": PHRASES,
}
