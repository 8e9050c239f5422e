"""Check SQL of k-means for several k: starts, rounds, labels and scores."""

from __future__ import annotations

from collections.abc import Sequence

from ospara.operators.clustering import DIGITS, ROUNDS, START_ROWS


def kmeans_sql(points: str, ks: Sequence[int], tag: str = "", rounds: int = ROUNDS) -> str:
    """CTEs over ``points`` (r, v): ``label<tag>`` (k, c, r, v) and ``score<tag>`` (k, silhouette, davies_bouldin, combined)."""
    gap = f"round(power(list_distance({{}}, {{}}), 2), {DIGITS})"
    steps = [
        f"pts{tag} AS MATERIALIZED ({points})",
        f"""smp{tag} AS MATERIALIZED (SELECT v, row_number() OVER (ORDER BY sha256(r::VARCHAR), v) AS o FROM pts{tag}
              QUALIFY o <= {START_ROWS})""",
        f"f{tag}_0 AS (SELECT v FROM smp{tag} WHERE o = 1)",
        f"n{tag}_0 AS MATERIALIZED (SELECT s.o, s.v, {gap.format('s.v', 'f.v')} AS d FROM smp{tag} s, f{tag}_0 f)",
    ]
    for i in range(1, max(ks)):
        steps.append(f"f{tag}_{i} AS MATERIALIZED (SELECT v FROM n{tag}_{i - 1} ORDER BY d DESC, o LIMIT 1)")
        steps.append(f"n{tag}_{i} AS MATERIALIZED (SELECT n.o, n.v, least(d, {gap.format('n.v', 'f.v')}) AS d FROM n{tag}_{i - 1} n, f{tag}_{i} f)")
    starts = " UNION ALL ".join(f"SELECT {i} AS c, v FROM f{tag}_{i}" for i in range(max(ks)))
    steps.append(f"c{tag}_0 AS MATERIALIZED (SELECT k, c, v FROM ({starts}) JOIN (SELECT unnest({list(ks)}) AS k) ON c < k)")
    for i in range(rounds + 1):
        steps.append(f"""a{tag}_{i} AS MATERIALIZED (SELECT c.k, c.c, p.r, p.v FROM pts{tag} p, c{tag}_{i} c
              QUALIFY row_number() OVER (PARTITION BY c.k, p.r ORDER BY {gap.format('p.v', 'c.v')}, c.c) = 1)""")
        steps.append(f"""m{tag}_{i} AS MATERIALIZED (SELECT k, c, list(x ORDER BY j) AS v FROM (SELECT k, c, j, avg(x) AS x FROM (
              SELECT k, c, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM a{tag}_{i}) GROUP BY k, c, j) GROUP BY k, c)""")
        if i < rounds:
            steps.append(f"""c{tag}_{i + 1} AS MATERIALIZED (SELECT k, c, coalesce(m.v, c.v) AS v
              FROM c{tag}_{i} c LEFT JOIN m{tag}_{i} m USING (k, c))""")
    steps += [
        f"label{tag} AS (FROM a{tag}_{rounds})",
        f"""st{tag} AS MATERIALIZED (SELECT k, c, m.v AS m, count(*) AS n, sum(list_dot_product(a.v, a.v)) AS q,
              avg(list_distance(a.v, m.v)) AS s FROM label{tag} a JOIN m{tag}_{rounds} m USING (k, c) GROUP BY k, c, m.v)""",
        f"""w{tag} AS (SELECT a.k, a.c, max(CASE WHEN list_distance(a.m, b.m) > 0 THEN (a.s + b.s) / list_distance(a.m, b.m) ELSE 0 END) AS w
              FROM st{tag} a JOIN st{tag} b ON a.k = b.k AND a.c <> b.c GROUP BY a.k, a.c)""",
        f"db{tag} AS (SELECT k, avg(w) AS db FROM w{tag} GROUP BY k)",
        f"""e{tag} AS (SELECT a.k, a.r, a.c, s.c AS other, s.n, list_dot_product(a.v, a.v) + s.q / s.n - 2 * list_dot_product(a.v, s.m) AS d
              FROM label{tag} a JOIN st{tag} s ON a.k = s.k)""",
        f"""g{tag} AS (SELECT k, r, max(CASE WHEN c = other THEN d * n / greatest(n - 1, 1) END) AS a, max(CASE WHEN c = other THEN n END) AS n,
              min(CASE WHEN c <> other THEN d END) AS b FROM e{tag} GROUP BY k, r)""",
        f"""score{tag} AS (SELECT k, silhouette, db AS davies_bouldin, silhouette - db / 10 AS combined FROM (
              SELECT k, avg(CASE WHEN n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END) AS silhouette FROM g{tag} GROUP BY k) JOIN db{tag} USING (k))""",
    ]
    return ",\n".join(steps)
