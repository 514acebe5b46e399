"""DuckDB SQL for the corpus queries that SQL can express, by other means than the operators."""

from __future__ import annotations


def _crc32(text: str) -> str:
    """Unsigned crc32 of the UTF-8 bytes of a text expression, by the bitwise definition."""
    h = f"hex(encode({text}))"
    # bit i of the stream: byte i // 8, least significant bit first; its nibble is the second hex digit for bits 0 to 3
    nibble = f"(instr('0123456789ABCDEF', substr({h}, ((i // 8) * 2 + if(i % 8 < 4, 2, 1))::int, 1)) - 1)"
    bits = f"list_transform(range(length({h}) * 4), lambda i: (({nibble}) >> (i % 4)::int) & 1)"
    step = "xor(c >> 1, 3988292384::ubigint * (xor(c, b::ubigint) & 1::ubigint))"
    return f"xor(list_reduce({bits}, lambda c, b: {step}, 4294967295::ubigint), 4294967295::ubigint)"


def _encoded(value: str) -> str:
    return f"case when {value} is null then '-' else octet_length(encode({value}::varchar))::varchar || ':' || {value}::varchar end"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_encoded(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


#: Levels by recursion, each run put together by an ordered concatenation; proofs by looking up the
#: node beside each ancestor.
OP13 = f"""
with recursive given as (
  select doc_id, lang, {_leaf("n_chars")} as leaf,
         case when {_crc32("doc_id::varchar")} % 7 = 0 then {_leaf("(n_chars::hugeint + 1)")} else {_leaf("n_chars")} end as leaf_now
  from documents
), leaves as (
  select *, coalesce('=' || lang, '') as g,
         row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as idx,
         count(*) over (partition by lang) as n
  from given
), nodes as (
  select g, 0 as lvl, idx, n, leaf as h from leaves
  union all
  select g, lvl + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' order by idx)) from nodes
  where n > 1 group by g, lvl, idx // 2
), subroots as (
  select g, lvl as depth, h, row_number() over (order by encode(g)) - 1 as idx, count(*) over () as n from nodes where n = 1
), tops as (
  select 0 as lvl, idx, n, h from subroots
  union all
  select lvl + 1, idx // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' order by idx)) from tops
  where n > 1 group by lvl, idx // 2
), ways as (
  select l.doc_id, l.g, l.idx, l.leaf, l.leaf_now, s.h as subroot, s.depth, s.idx as top_idx,
         (select h from tops where n = 1) as root, (select max(lvl) from tops) as top_depth
  from leaves l join subroots s using (g)
), steps as (
  select w.g, w.idx, k as place, coalesce(b.h, '') as other, (w.idx >> k) % 2 = 1 as is_right
  from (select *, unnest(range(depth)) as k from ways) w
  left join nodes b on b.g = w.g and b.lvl = w.k and b.idx = xor(w.idx >> w.k, 1)
  union all
  select w.g, w.idx, w.depth + k, coalesce(b.h, ''), (w.top_idx >> k) % 2 = 1
  from (select *, unnest(range(top_depth)) as k from ways) w
  left join tops b on b.lvl = w.k and b.idx = xor(w.top_idx >> w.k, 1)
), proofs as (
  select g, idx, list({{'other': other, 'is_right': is_right}} order by place) as proof from steps group by g, idx
), folded as (
  select w.*, coalesce(list_reduce(list_transform(p.proof, lambda s: s.other), lambda a, b: a || b, ''), '') as siblings,
         coalesce(list_reduce(list_transform(p.proof, lambda s: if(s.is_right, 'R', 'L') || s.other),
           lambda a, s: sha256(if(s[1] = 'R', s[2:] || a, a || s[2:])), w.leaf_now), w.leaf_now) as folded_root
  from ways w left join proofs p using (g, idx)
)
select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, folded_root, folded_root = root as verified from folded
"""

_FAR = 1000000000


def _least(*options: str) -> str:
    return f"list_min([{', '.join(options)}])"


def _move(state: str, cost: str, letter: str) -> str:
    return f"{{'c': {state}.c + ({cost}), 'a': {state}.a || '{letter}'}}"


#: Turns in, one state for each place in the grammar (n nothing, s system, u user, a assistant), each
#: with the cheapest cost and its least audit; insertions are relaxed before every row and at the end.
_RELAX = (
    f"{{'n': x.n, 's': x.s, 'u': {_least('x.u', _move('x.n', '3', 'I'), _move('x.s', '3', 'I'), _move('x.a', '3', 'I'))}, "
    f"'a': {_least('x.a', _move('x.u', '3', 'I'))}}}"
)


def _relaxed(state: str, times: int) -> str:
    for _ in range(times):
        state = f"list_transform([{state}], lambda x: {_RELAX})[1]"
    return state


def _read(state: str, row: str) -> str:
    gone, extra = f"if({row}.fault in ('b', 'd'), {_FAR}, 0)", f"if({row}.fault = 't', 3, 0)"

    def turn(source: str, place: str) -> list[str]:
        same = _move(source, f"{gone} + {extra} + if({row}.role = '{place}', 0, {_FAR})", "K")
        other = _move(source, f"{gone} + {extra} + 3 + if({row}.role = '{place}', {_FAR}, 0)", "R")
        return [same, other]

    delete = {q: _move(f"{state}.{q}", "4", "D") for q in "nsua"}
    to_user = [o for q in "nsa" for o in turn(f"{state}.{q}", "u")]
    system = _move(f"{state}.n", f"{gone} + {extra} + if({row}.role = 's', 0, {_FAR})", "K")
    return (
        f"{{'n': {delete['n']}, 's': {_least(delete['s'], system)}, "
        f"'u': {_least(delete['u'], *to_user)}, 'a': {_least(delete['a'], *turn(f'{state}.u', 'a'))}}}"
    )


_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_START = f"{{'n': {{'c': 0::bigint, 'a': ''}}, 's': {{'c': {_FAR}::bigint, 'a': ''}}, 'u': {{'c': {_FAR}::bigint, 'a': ''}}, 'a': {{'c': {_FAR}::bigint, 'a': ''}}}}"

OP11 = f"""
with recursive rolled as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         {_crc32("coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ')")} % 20 as luck
  from conversations
), hurt as (
  select conv_id, turn, if(luck = 4, 'user', role) as role,
         case luck when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, time
  from (select *, unnest(if(luck = 3, [1, 2], [1])) as time from rolled where luck <> 0)
), ordered as (
  select *, coalesce('=' || conv_id::varchar, '') as g, rtrim(text, {_WHITE}) as ended,
         row_number() over (partition by conv_id order by turn nulls first, role, text, time) as pos
  from hurt
), coded as (
  select g, conv_id, turn, role, text, pos, if(role[1] in ('s', 'u', 'a'), role[1], 'x') as initial,
         case when ended = '' then 'b'
              when row_number() over (partition by g, role, text order by pos) > 1 then 'd'
              when ended[-1] not in ('.', '!', '?') then 't' else '-' end as fault,
         lead(if(role[1] in ('s', 'u', 'a'), role[1], 'x')) over (partition by g order by pos) as following
  from ordered
), states as (
  select g, 0::bigint as pos, {_START} as st from coded group by g
  union all
  select s.g, s.pos + 1, list_transform([{_relaxed("s.st", 3)}], lambda x: {_read("x", "{'role': r.initial, 'fault': r.fault}")})[1]
  from states s join coded r on r.g = s.g and r.pos = s.pos + 1
), ends as (
  select g, list_transform([{_relaxed("st", 3)}], lambda x: {_least("x.n", "x.a")})[1] as best
  from states qualify row_number() over (partition by g order by pos desc) = 1
), letters as (
  select g, best.c as cost, best.a as audit, unnest(range(1, length(best.a) + 1)) as k, best.a[unnest(range(1, length(best.a) + 1))] as letter
  from ends
), placed as (
  select *, count(*) filter (letter <> 'I') over w as pos, count(*) filter (letter <> 'D') over w as seq
  from letters window w as (partition by g order by k)
), spelt as (
  select p.g, p.seq, p.letter, c.role, c.text, c.initial,
         bool_or(p.seq = 1 and p.letter = 'K' and c.initial = 's') over (partition by p.g) as has_system
  from placed p left join coded c on c.g = p.g and c.pos = p.pos and p.letter <> 'I'
  where p.letter <> 'D'
), lines as (
  select g, seq, case letter when 'K' then role else if((seq % 2 = 1) <> has_system, 'user', 'assistant') end
                 || ':' || if(letter = 'I', '', text) as line
  from spelt
), texts as (
  select g, sha256(string_agg(line, chr(10) order by seq)) as repaired_sha256 from lines group by g
), faults as (
  select g, any_value(conv_id) as conv_id,
         coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
         count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
         count(*) filter (fault = 't') as truncated,
         count(*) filter (following is not null and initial || following not in ('su', 'ua', 'au')) as illegal
  from coded group by g
), every as (select distinct conv_id, coalesce('=' || conv_id::varchar, '') as g from conversations)
select e.conv_id, coalesce(f.gaps, 0) as gaps, coalesce(f.blank, 0) as blank, coalesce(f.duplicate, 0) as duplicate,
       coalesce(f.truncated, 0) as truncated, coalesce(f.illegal, 0) as illegal, coalesce(x.best.c, 0) as cost,
       coalesce(x.best.a, '') as audit, coalesce(t.repaired_sha256, sha256('')) as repaired_sha256
from every e left join faults f using (g) left join ends x using (g) left join texts t using (g)
"""

ORACLE_SQL = {"op11_conversation_repair": OP11, "op13_merkle_manifest": OP13}
