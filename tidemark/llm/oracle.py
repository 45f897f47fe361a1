"""What SQL can express of the operators, for DuckDB over the same tables."""

ORACLE: dict[str, str] = {
    "op1_chat_perspectives": r"""
with t as (
  select distinct conv_id, cast(turn as bigint) turn, coalesce(role, 'unknown') role, coalesce("text", '') "text", coalesce(turn // 64, -1) block
  from conversations),
p as (select distinct conv_id, role perspective from conversations where role is not null and role <> 'system'),
v as (
  select t.conv_id, p.perspective, t.block, coalesce(t.turn, 0) turn, t.role, t."text", t.role = p.perspective learn,
    case when t.role = p.perspective then '<|assistant|>' || chr(10) when t.role = 'system' then '<|system|>' || chr(10)
         else '<|user name=' || replace(t.role, '<|', '<\|') || '|>' || chr(10) end head,
    replace(t."text", '<|', '<\|') || '<|end|>' || chr(10) tail
  from t join p on t.conv_id is not distinct from p.conv_id)
select conv_id, perspective, block, count(*) n_turns,
  string_agg(head || tail, '' order by turn, role, "text") "text",
  string_agg(length(head) || 'x0,' || length(tail) || 'x' || cast(learn as int), ',' order by turn, role, "text") mask,
  cast(coalesce(sum(length(tail)) filter (learn), 0) as bigint) n_learned
from v group by conv_id, perspective, block""",
    "op3_decontamination": r"""
with d as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from documents),
b as (
  select cast(item_id as varchar) item_id, list_filter(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') w
  from benchmark),
i as (
  select item_id, n, array_to_string(w[s : s + n - 1], ' ') win
  from (select item_id, w, least(len(w), 13) n, unnest(range(1, len(w) - least(len(w), 13) + 2)) s from b where len(w) > 0)),
l as (select distinct n from i),
c as (
  select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') win
  from (select doc_id, w, l.n, unnest(range(1, len(w) - l.n + 2)) s from d, l where len(w) >= l.n)),
h as (select c.doc_id, c.s, c.n, i.item_id from c join i on c.win = i.win),
k as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(s, s + n)) p from h) group by doc_id),
m as (select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) items from (select distinct doc_id, item_id from h) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) contaminated
from d left join k using (doc_id) left join m using (doc_id)""",
    "op11_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') lang, unnest(regexp_split_to_array(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) piece
  from documents),
w as (select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') w from pieces),
grams as (
  select lang, n, w[s : s + n - 1] ws
  from (select lang, w, n, unnest(range(1, len(w) - n + 2)) s from w, (values (1), (2), (3)) l(n) where len(w) >= n)),
f as (select lang, n, ws, array_to_string(ws, ' ') phrase, count(*) f from grams group by lang, n, ws),
totals as (select lang, sum(f)::bigint n from f where n = 1 group by lang),
often as (select * from f where f >= 10),
cuts as (
  select lang, n, phrase, ws, f a, unnest(range(1, n)) k from often where n > 1),
rated as (
  select c.lang, c.n, c.phrase, c.ws, c.a, c.k, x.f l, y.f r, (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) score
  from cuts c
  join often x on x.lang = c.lang and x.phrase = array_to_string(c.ws[1 : c.k], ' ')
  join often y on y.lang = c.lang and y.phrase = array_to_string(c.ws[c.k + 1 : c.n], ' ')),
weakest as (
  select * from rated qualify row_number() over (partition by lang, phrase order by score, k) = 1),
held as (
  select lang, phrase, max(a) longer
  from (select lang, a, array_to_string(ws[1 : 2], ' ') phrase from weakest where n = 3
        union all select lang, a, array_to_string(ws[2 : 3], ' ') from weakest where n = 3)
  group by lang, phrase),
kept as (
  select w.* from weakest w left join held h on h.lang = w.lang and h.phrase = w.phrase and w.n = 2
  where h.longer is null or 100 * h.longer < 50 * w.a),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) "rank" from kept)
select r.lang, "rank", phrase, a, l, r, t.n, score::bigint score
from ranked r join totals t on t.lang = r.lang where "rank" <= 2000""",
}
