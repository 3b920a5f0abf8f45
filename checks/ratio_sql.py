"""The sequence ratio and the best match as SQL.

The ratio takes the longest common block (the first one in the left, then in the right string),
then the blocks left and right of it, and so on: a recursive query over the pieces.
"""

_LONGEST = """list_max(list_filter(flatten(list_transform(range(1, length(a) + 1), lambda i:
    list_transform(range(1, length(a) - i + 2), lambda n: {'n': n, 'i': -i,
        'j': -instr(b, substr(a, i, n))}))), lambda hit: hit.j < 0))"""


def ratio(pairs: str) -> str:
    """Common table expressions ``pieces`` and ``ratios (x, y, ratio)`` for a table of x and y."""
    return f"""
pieces AS (SELECT x, y, a, b, {_LONGEST} AS m FROM (SELECT x, y, x AS a, y AS b FROM {pairs}) p
  UNION ALL SELECT x, y, a, b, {_LONGEST} AS m FROM (
    SELECT x, y,
      CASE side WHEN 1 THEN substr(a, 1, -m.i - 1) ELSE substr(a, -m.i + m.n) END AS a,
      CASE side WHEN 1 THEN substr(b, 1, -m.j - 1) ELSE substr(b, -m.j + m.n) END AS b
    FROM (SELECT *, unnest([1, 2]) AS side FROM pieces WHERE m IS NOT NULL) s) p
  WHERE a <> '' AND b <> ''),
ratios AS (SELECT x, y, CAST(2 AS DOUBLE) * CAST(sum(coalesce(m.n, 0)) AS DOUBLE)
    / (length(x) + length(y)) AS ratio FROM pieces GROUP BY x, y)"""


def best_match(left: str, right: str, threshold: float, ordered: bool = False) -> str:
    """Common table expressions up to ``best (key, match, score)`` for two tables with ``key``.

    Pairs that share too few characters for the threshold are left out before the recursion. Ties go to
    the smaller key, or to the smaller ``ord`` of the right table.
    """
    tie = f"(SELECT ord FROM {right} o WHERE o.key = y)" if ordered else "y"
    counts = """list_transform(string_split('abcdefghijklmnopqrstuvwxyz_0123456789', ''), lambda ch:
        length(key) - length(replace(key, ch, '')))"""
    return f"""
left_counts AS MATERIALIZED (SELECT key, length(key) AS n, {counts} AS c FROM {left}
    WHERE key <> '' AND key NOT IN (SELECT key FROM {right})),
right_counts AS MATERIALIZED (SELECT key, length(key) AS n, {counts} AS c FROM {right} WHERE key <> ''),
candidates AS MATERIALIZED (SELECT l.key AS x, r.key AS y FROM left_counts l JOIN right_counts r
    ON list_sum(list_transform(range(1, 38), lambda i: least(l.c[i], r.c[i])))
       >= {threshold} / 2 * (l.n + r.n) - 0.000001),
{ratio("candidates")},
ranked AS (SELECT *, row_number() OVER (PARTITION BY x ORDER BY ratio DESC, {tie}) AS place FROM ratios
    WHERE ratio >= CAST({threshold} AS DOUBLE)),
best AS (SELECT key, key AS match, CAST(1 AS DOUBLE) AS score FROM {left}
    WHERE key <> '' AND key IN (SELECT key FROM {right})
    UNION ALL SELECT x, y, ratio FROM ranked WHERE place = 1)"""
