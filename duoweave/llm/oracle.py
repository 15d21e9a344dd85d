"""DuckDB SQL of the manifest and the turn repair."""


def crc(text: str) -> str:
    """Unsigned crc32 of an ASCII text, eight shifts per character."""
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''),
      lambda c: ascii(c)::BIGINT)), lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
      lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::BIGINT)"""


def _field(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x}::VARCHAR END"


def _leaf(text: str = "text") -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _steps(nodes: str, tree: str) -> str:
    """Per node: its run's digests, with * in its own place."""
    return f"""SELECT x.{tree}, x.level, x.idx, string_agg(CASE WHEN o.idx = x.idx THEN '*' ELSE o.h END, '' ORDER BY o.idx) AS step
  FROM {nodes} x JOIN {nodes} o ON o.{tree} = x.{tree} AND o.level = x.level AND o.idx // 3 = x.idx // 3
  WHERE x.n > 1 GROUP BY ALL"""


OP12_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, {_leaf()} AS leaf, dense_rank() OVER (ORDER BY source NULLS FIRST) AS src,
         CASE WHEN doc_id IS NOT NULL AND ({crc('doc_id::VARCHAR')}) % 2 = 0
              THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf()} END AS bent FROM documents
), p AS (
  SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY src) AS n FROM d
), lv AS (
  SELECT src, 0 AS level, idx, leaf AS h, n FROM p
  UNION ALL
  SELECT src, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 2) // 3) FROM lv WHERE n > 1 GROUP BY src, level, idx // 3
), s AS (
  SELECT src, h AS subroot FROM lv WHERE n = 1
), tp AS (
  SELECT 0 AS tree, 0 AS level, src - 1 AS idx, subroot AS h, count(*) OVER () AS n FROM s
  UNION ALL
  SELECT tree, level + 1, idx // 3, sha256(string_agg(h, '' ORDER BY idx)), any_value((n + 2) // 3) FROM tp WHERE n > 1 GROUP BY tree, level, idx // 3
), st AS ({_steps('lv', 'src')}
), tt AS ({_steps('tp', 'tree')}
), w AS (
  SELECT p.doc_id, p.src, p.idx, p.leaf, p.bent, list(st.step ORDER BY st.level) FILTER (st.step IS NOT NULL) AS low
  FROM p LEFT JOIN st ON st.src = p.src AND st.idx = p.idx // (3 ** st.level)::BIGINT GROUP BY ALL
), t AS (
  SELECT s.src, s.subroot, list(tt.step ORDER BY tt.level) FILTER (tt.step IS NOT NULL) AS high
  FROM s LEFT JOIN tt ON tt.idx = (s.src - 1) // (3 ** tt.level)::BIGINT GROUP BY ALL
), f AS (
  SELECT w.*, t.subroot, (SELECT h FROM tp WHERE n = 1) AS root, list_concat(coalesce(low, []), coalesce(high, [])) AS steps
  FROM w JOIN t USING (src)
)
SELECT doc_id, leaf, subroot, root, sha256(replace(list_aggregate(list_prepend('', steps), 'string_agg', ''), '*', '')) AS proof_sha256,
       list_reduce(list_prepend(bent, steps), lambda a, b: sha256(replace(b, '*', a))) AS folded_root,
       list_reduce(list_prepend(bent, steps), lambda a, b: sha256(replace(b, '*', a))) = root AS verified FROM f
"""


def _add(state: str, cost: str, edit: str, line: str = "") -> str:
    lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return f"struct_pack(c := {state}.c + {cost}, a := {state}.a || '{edit}', t := {lines})"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


_OWN = "f.role || ':' || f.text"
_STAY = "CASE WHEN f.fault = 'truncated' THEN 5 WHEN f.fault = '' THEN 0 ELSE 1000000000 END"


def _turn(state: str, initial: str, role: str) -> str:
    """The row as a turn of ``role``: kept if it is one, else given the role."""
    keep, give = _add(state, _STAY, "K", _OWN), _add(state, f"1 + {_STAY}", "R", f"'{role}:' || f.text")
    return f"CASE WHEN f.ini = '{initial}' THEN {keep} ELSE {give} END"


_STATE = "struct_pack(c := {}, a := '', t := []::VARCHAR[])"
#: Turns inserted first where that is cheaper: states s0, s1, u2, u3.
_FILLED = f"""SELECT *, {_least('s3', _add('u2', '5', 'I', "'assistant:'"))} AS u3 FROM (
    SELECT *, {_least('s2', *[_add(s, '5', 'I', "'user:'") for s in ('s0', 's1', 's3')])} AS u2 FROM {{}})"""

OP13_SQL = f"""
WITH RECURSIVE r AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         ({crc("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")}) % 20 AS how FROM conversations
), d AS (
  SELECT conv_id, turn, CASE WHEN how = 4 THEN 'user' ELSE role END AS role,
         CASE how WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM r, LATERAL (SELECT unnest(range(CASE WHEN how = 3 THEN 2 ELSE 1 END))) WHERE how <> 0
), k AS (
  SELECT conv_id, row_number() OVER () AS conv FROM (SELECT DISTINCT conv_id FROM conversations)
), o AS (
  SELECT k.conv, d.turn, d.role, d.text, left(d.role, 1) AS ini,
         row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         rtrim(d.text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body
  FROM d JOIN k ON d.conv_id IS NOT DISTINCT FROM k.conv_id
), f AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, md5(text) ORDER BY i) > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv ORDER BY i) AS prev FROM o
), c AS (
  SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM f GROUP BY conv
), dp AS (
  SELECT conv, 0::BIGINT AS i, {_STATE.format('0::BIGINT')} AS s0,
         {', '.join(f"{_STATE.format('1000000000::BIGINT')} AS s{q}" for q in (1, 2, 3))} FROM k
  UNION ALL
  SELECT p.conv, f.i, {_add('p.s0', '2', 'D')}, {_least(_add('p.s1', '2', 'D'), f"CASE WHEN f.ini = 's' THEN {_add('p.s0', _STAY, 'K', _OWN)} ELSE {_add('p.s1', '2', 'D')} END")},
         {_least(_add('p.u2', '2', 'D'), *[_turn(s, 'u', 'user') for s in ('p.s0', 'p.s1', 'p.u3')])},
         {_least(_add('p.u3', '2', 'D'), _turn('p.u2', 'a', 'assistant'))}
  FROM ({_FILLED.format('dp')}) p JOIN f ON f.conv = p.conv AND f.i = p.i + 1
), e AS (
  SELECT p.conv, {_least('p.s0', 'p.u3')} AS best FROM ({_FILLED.format('dp')}) p JOIN c ON c.conv = p.conv AND p.i = c.n
)
SELECT k.conv_id, {', '.join(f"coalesce(c.{x}, 0)::BIGINT AS {x}" for x in ('gaps', 'blank', 'duplicate', 'truncated', 'illegal'))},
       coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM k LEFT JOIN c USING (conv) LEFT JOIN e USING (conv)
"""
