"""DuckDB SQL with the expected rows of the queries that SQL can express."""

from __future__ import annotations

from waybill.llm import centroids
from waybill.llm.chat import BEGIN, CLOSE, CONTROL, END, OPEN
from waybill.llm.queries import CONTROL_CONVERSATION, URL_RULES

EXACT = r"""
with t as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') norm from documents),
g as (select *, min(doc_id) over (partition by norm) keep_id, count(*) over (partition by norm) group_size from t)
select doc_id, keep_id, group_size, doc_id = keep_id kept, sha256(norm) text_sha256 from g
"""

# Sources in order of size per weight: those before the first that stays below its cap are clamped.
MIXING = r"""
with recursive d as (select doc_id, source, md5(concat_ws(':', '7', cast(doc_id as varchar))) draw,
  len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) size from documents),
s as (select source, sum(size)::bigint source_size,
  case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5 when 1 then 2 else 1 end w from d group by source),
o as (select *, (sum(source_size) over ())::double total,
  coalesce(sum(3 * source_size) over (order by source_size / w, w, source nulls last rows between unbounded preceding and 1 preceding), 0) caps,
  sum(w) over (order by source_size / w, w, source nulls last rows between current row and unbounded following) open_w from s),
l as (select *, (total - caps) / open_w as level from o),
f as (select min(level) level from (select level from l where w * level <= 3 * source_size order by caps limit 1)),
p as (select l.source, source_size, case when w * f.level > 3 * source_size then 3.0 * source_size else w * f.level end target from l, f),
q as (select *, case when source_size = 0 then 0 else least(3, floor(target / source_size)) end whole from p),
c as (select d.*, q.source_size, q.target, q.whole, row_number() over (partition by d.source order by draw, size, doc_id) pos
  from d join q on d.source is not distinct from q.source),
step as (select source, 0::bigint low, floor(target - whole * source_size)::bigint room, target, null::bigint span_low, null::bigint span_room from q
  union all
  select source, min(pos) filter (upto > room), room - coalesce(min(upto - size) filter (upto > room), max(upto))::bigint, target, low, room
  from (select step.*, pos, size, sum(size) over (partition by step.source order by pos) upto
    from step join c on step.source is not distinct from c.source and pos > step.low and size between 1 and step.room where step.room * 1000 > step.target) z
  group by source, target, low, room),
rooms as (select source, min(room) room from step group by source),
t as (select c.*, exists (select 1 from step where step.source is not distinct from c.source and c.pos > span_low
  and c.pos < coalesce(step.low, c.pos + 1) and c.size between 1 and span_room) once from c),
x as (select doc_id, row_number() over (partition by t.source order by size, pos) k
  from t join rooms on t.source is not distinct from rooms.source where not once and size > 0 and size < 2 * room)
select t.doc_id, size::bigint size, source_size, target::double target,
  (size * (whole + case when once or x.k = 1 then 1 else 0 end))::bigint taken
from t left join x on t.doc_id = x.doc_id and x.k = 1
"""

EMBEDDINGS = """
with recursive v as (select vec_id, label, list_transform(embedding, lambda x: x::double) e from embeddings),
g as (select * from v where label is not null and e is not null
  and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
k as (select a.vec_id a, b.vec_id b from g a join g b on a.label = b.label and a.vec_id <> b.vec_id and len(a.e) = len(b.e)
  where list_cosine_similarity(a.e, b.e) >= 0.93),
r as (select vec_id a, vec_id b from v union select r.a, k.b from r join k on r.b = k.a),
n as (select a, count(*) n from k group by a)
select a vec_id, coalesce(max(n), 0)::bigint n_links, min(b) component_id, a = min(b) kept
from r left join n using (a) group by a
"""

_RULES = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)

URLS = f"""
with r(h, p, v) as (values {_RULES}),
t as (select page_id, case when strpos(coalesce(url, ''), '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end rest from pages),
u as (select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
  regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from t),
m as (select page_id, h || p rule, v, row_number() over (partition by page_id order by length(h || p) desc, length(p) desc) k
  from u join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule, coalesce(v, 'allow') verdict from u left join (select * from m where k = 1) using (page_id)
"""


def _escaped(text: str) -> str:
    text = f"replace({text}, '\\', '\\\\')"
    for mark in CONTROL:
        text = f"replace({text}, '{mark}', '{mark[0]}\\{mark[1:]}')"
    return text


_EXTRA = " union all ".join(
    f"select {conv}, {turn}, '{role}', '{text}'" for conv, turn, role, text in CONTROL_CONVERSATION
)

CHAT = f"""
with t as (select conv_id, turn, coalesce(role, '') role, coalesce(text, '') text
  from (select conv_id, turn, role, text from conversations union all {_EXTRA})),
f as (select *, coalesce(lag(role) over (partition by conv_id order by turn, role, text) <> role, true) starts from t)
select conv_id, count(*) n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) loss_sha256,
  (sum(length({_escaped("text")}) + {len(OPEN + CLOSE)})
    + sum(case when starts then length({_escaped("role")}) + {len(BEGIN + END)} else 0 end))::bigint formatted_chars
from f group by conv_id
"""



def _rounds() -> str:
    """The rounds of the clustering; distances are exact in doubles, k numbers the centroids."""
    kept = f"""
v as materialized (select vec_id, list_transform(embedding, lambda x: floor({centroids.SCALE} * x::double)) e,
    sha256('{centroids.SEED}:' || vec_id) draw
  from embeddings where len(embedding) = {centroids.LENGTH}
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
c0 as materialized (select row_number() over (order by draw, e) - 1 k, e from v order by draw, e limit {centroids.CENTROIDS})"""
    steps = [kept]
    for r in range(centroids.ROUNDS + 1):
        gap = "list_inner_product(v.e, v.e) - 2 * list_inner_product(v.e, c.e) + list_inner_product(c.e, c.e)"
        steps.append(f"""
m{r} as materialized (select vec_id, draw, v.e, min(({gap})::hugeint * 64 + k) m from v, c{r} c group by all),
a{r} as materialized (select vec_id, e, m % 64 k, (m // 64)::bigint distance from m{r})""")
        if r < centroids.ROUNDS:
            steps.append(f"""
s{r} as (select k, i, floor_sum(x) x from (select k, unnest(e)::hugeint x, generate_subscripts(e, 1) i from a{r}) group by k, i),
c{r + 1} as materialized (select c.k, coalesce(n.e, c.e) e from c{r} c
  left join (select k, list(x::double order by i) e from s{r} group by k) n using (k))""")
    text = ",".join(steps)
    return text.replace("floor_sum(x)", "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)")


CENTROIDS = f"""
with {_rounds()}
select vec_id, a.k::int as cluster, distance, (sum(distance) over (partition by a.k))::bigint cluster_inertia,
  (sum(distance) over ())::bigint inertia,
  sha256(array_to_string(list_transform(c.e, lambda x: x::bigint), ',')) centroid_sha256
from a{centroids.ROUNDS} a join c{centroids.ROUNDS} c using (k)
"""

ORACLES = {
    "op1_exact_dedup": EXACT,
    "op3_mixing": MIXING,
    "op6_embedding_dedup": EMBEDDINGS,
    "op7_url_rules": URLS,
    "op10_chat_format": CHAT,
    "op13_centroids": CENTROIDS,
}
