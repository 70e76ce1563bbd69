"""SQL counterparts of fitted models: the same steps, written out for a given number of features."""

from __future__ import annotations

from math import isqrt

from accordant.operators.forest import BINS, DRAW_STEPS
from accordant.operators.models import DIGITS
from accordant.operators.outliers import DRAWS


def newton_sql(source: str, features: list[str], steps: int = 14, c: float = 1.0) -> str:
    """One row with the coefficients ``b0`` (intercept), ``b1``, ... after ``steps`` Newton steps over ``source`` (with ``label``)."""
    d = len(features) + 1
    x = ["1e0", *[f"x{i}" for i in range(1, d)]]
    parts = [f"newton_rows AS MATERIALIZED (SELECT {', '.join(f'COALESCE({f}, 0)::DOUBLE AS x{i + 1}' for i, f in enumerate(features))}, label::DOUBLE AS y, COUNT(*) AS n FROM {source} GROUP BY ALL)",
             f"newton0 AS MATERIALIZED (SELECT {', '.join(f'0e0 AS b{j}' for j in range(d))})"]
    z = " + ".join(f"b{j} * {t}" if j else "b0" for j, t in enumerate(x))
    for s in range(steps):
        sums = [f"ANY_VALUE(b{j}) AS b{j}" for j in range(d)]
        sums += [f"SUM(n * (y - p) * {t}) - {0 if j == 0 else 1 / c} * ANY_VALUE(b{j}) AS r{j}" for j, t in enumerate(x)]
        sums += [f"SUM(n * p * (1 - p) * {x[j]} * {x[k]}) + {1 / c if j == k and j else 0} AS a{j}_{k}" for j in range(d) for k in range(j, d)]
        sql = f"SELECT {', '.join(sums)} FROM (SELECT *, 1 / (1 + EXP(-({z}))) AS p FROM newton_rows, newton{s})"
        for k in range(d - 1):  # eliminate column k below row k
            new = [f"a{i}_{j} - a{k}_{i} * a{k}_{j} / a{k}_{k} AS a{i}_{j}" for i in range(k + 1, d) for j in range(i, d)]
            new += [f"r{i} - a{k}_{i} * r{k} / a{k}_{k} AS r{i}" for i in range(k + 1, d)]
            sql = f"SELECT * REPLACE ({', '.join(new)}) FROM ({sql})"
        for i in range(d - 1, -1, -1):
            rest = "".join(f" - a{i}_{j} * s{j}" for j in range(i + 1, d))
            sql = f"SELECT *, (r{i}{rest}) / a{i}_{i} AS s{i} FROM ({sql})"
        parts.append(f"newton{s + 1} AS MATERIALIZED (SELECT {', '.join(f'b{j} + s{j} AS b{j}' for j in range(d))} FROM ({sql}))")
    return f"WITH {', '.join(parts)} SELECT {', '.join(f'ROUND(b{j}, {DIGITS}) AS b{j}' for j in range(d))} FROM newton{steps}"


def linear_sql(features: list[str], model: str = "m", row: str = "") -> str:
    """P(label = 1) of a row of coefficients ``model`` over the features of ``row``."""
    terms = "".join(f" + {model}.b{i + 1} * COALESCE({row}{f}, 0)" for i, f in enumerate(features))
    return f"1 / (1 + EXP(-({model}.b0{terms})))"


def _mod(x: str, seed: int, modulus: int) -> str:
    return f"(CAST('0x' || SUBSTR(MD5('{seed}|' || {x}), 1, 14) AS BIGINT) % {modulus})"


def random_forest_sql(train: str, rows: str, key: str, features: list[str], trees: int, depth: int, seed: int = 42) -> str:
    """Expressions up to ``forest_probability`` (``key``, ``probability``): a forest fitted over ``train`` (with ``label``), scored over ``rows``."""
    def score(a: str, b: str) -> str:
        return f"(({a}) * ({a}) + ({b}) * ({b})) / (({a}) + ({b}))::DOUBLE"

    k = len(features)
    binned = ", ".join(f"CAST(GREATEST(0, LEAST({BINS - 1}, FLOOR((COALESCE({f}, 0) - e.low{i}) / e.width{i}))) AS INTEGER)" for i, f in enumerate(features))
    ends = ", ".join(f"MIN(COALESCE({f}, 0))::DOUBLE AS low{i}, CASE WHEN MAX(COALESCE({f}, 0)) = MIN(COALESCE({f}, 0)) THEN 1e0 ELSE (MAX(COALESCE({f}, 0)) - MIN(COALESCE({f}, 0))) / {BINS}::DOUBLE END AS width{i}" for i, f in enumerate(features))
    place = f"((r * ((tree * 7919 + {seed * 104_729 + 1_299_709}) % {DRAWS}) + tree * 15485863) % {DRAWS}) / {float(DRAWS)!r}"
    times = " + ".join(f"CASE WHEN place >= {s!r} THEN 1 ELSE 0 END" for s in DRAW_STEPS)
    parts = [f"bin_ends AS MATERIALIZED (SELECT {ends} FROM {train})",
             f"binned AS MATERIALIZED (SELECT x, y, COUNT(*) AS n FROM (SELECT [{binned}] AS x, label AS y FROM {train}, bin_ends e) GROUP BY x, y)",
             f"""drawn AS (SELECT x, y, n, tree, {place} AS place FROM (SELECT *, {_mod("ARRAY_TO_STRING(x, ',') || '|' || y", seed, DRAWS)} AS r FROM binned), (SELECT UNNEST(RANGE({trees})) AS tree))""",
             f"""grown0 AS MATERIALIZED (SELECT tree, CAST(1 AS BIGINT) AS node, x, SUM(CASE WHEN y = 0 THEN w ELSE 0 END)::BIGINT AS w0, SUM(CASE WHEN y = 1 THEN w ELSE 0 END)::BIGINT AS w1
               FROM (SELECT *, n * ({times}) AS w FROM drawn) WHERE w > 0 GROUP BY tree, x)"""]
    for level in range(depth + 1):
        parts.append(f"totals{level} AS MATERIALIZED (SELECT tree, node, SUM(w0)::BIGINT AS t0, SUM(w1)::BIGINT AS t1 FROM grown{level} GROUP BY tree, node)")
        if level == depth:
            parts.append(f"cut{level} AS MATERIALIZED (SELECT tree, node, -1 AS feature, -1 AS bin, t1 / (t0 + t1)::DOUBLE AS p FROM totals{level})")
            break
        order = ", ".join(f"{{'o': MD5('{seed}|' || tree || '|' || node || '|{i}'), 'f': {i}}}" for i in range(k))
        left, right = score("l0", "l1"), score("t0 - l0", "t1 - l1")
        parts += [f"asked{level} AS (SELECT g.tree, g.node, c.f AS feature, g.x[c.f + 1] AS bin, w0, w1 FROM grown{level} g JOIN (SELECT tree, node, UNNEST(LIST_SORT([{order}])[1:{isqrt(k)}]) AS c FROM totals{level}) s ON s.tree = g.tree AND s.node = g.node)",
                  f"""best{level} AS MATERIALIZED (SELECT tree, node, MIN({{'g': -gain, 'f': feature, 'b': bin}}) AS s FROM (SELECT c.*, {left} + {right} AS gain, {score('t0', 't1')} AS whole
                    FROM (SELECT a.*, t.t0, t.t1, SUM(w0) OVER u AS l0, SUM(w1) OVER u AS l1 FROM (SELECT tree, node, feature, bin, SUM(w0)::BIGINT AS w0, SUM(w1)::BIGINT AS w1 FROM asked{level} GROUP BY ALL) a
                      JOIN totals{level} t ON t.tree = a.tree AND t.node = a.node WINDOW u AS (PARTITION BY a.tree, a.node, a.feature ORDER BY a.bin)) c WHERE l0 + l1 < t0 + t1) WHERE gain > whole * (1 + 1e-12) GROUP BY tree, node)""",
                  f"cut{level} AS MATERIALIZED (SELECT t.tree, t.node, COALESCE(b.s.f, -1) AS feature, COALESCE(b.s.b, -1) AS bin, t1 / (t0 + t1)::DOUBLE AS p FROM totals{level} t LEFT JOIN best{level} b ON b.tree = t.tree AND b.node = t.node)",
                  f"grown{level + 1} AS MATERIALIZED (SELECT g.tree, 2 * g.node + CASE WHEN g.x[c.feature + 1] <= c.bin THEN 0 ELSE 1 END AS node, g.x, g.w0, g.w1 FROM grown{level} g JOIN cut{level} c ON c.tree = g.tree AND c.node = g.node WHERE c.feature >= 0)"]
    parts += [f"forest_nodes AS MATERIALIZED ({' UNION ALL '.join(f'SELECT * FROM cut{level}' for level in range(depth + 1))})",
              f"asked_rows AS MATERIALIZED (SELECT {key}, [{binned}] AS x FROM {rows}, bin_ends e)",
              f"""path AS (SELECT x, tree, CAST(1 AS BIGINT) AS node FROM (SELECT DISTINCT x FROM asked_rows), (SELECT UNNEST(RANGE({trees})) AS tree)
                UNION ALL SELECT p.x, p.tree, 2 * p.node + CASE WHEN p.x[n.feature + 1] <= n.bin THEN 0 ELSE 1 END FROM path p JOIN forest_nodes n ON n.tree = p.tree AND n.node = p.node WHERE n.feature >= 0)""",
              f"forest_probability AS MATERIALIZED (SELECT a.{key}, s.probability FROM asked_rows a JOIN (SELECT p.x, ROUND(SUM(n.p) / {trees}, 8) AS probability FROM path p JOIN forest_nodes n ON n.tree = p.tree AND n.node = p.node WHERE n.feature < 0 GROUP BY p.x) s ON s.x = a.x)"]
    return "WITH RECURSIVE " + ",\n".join(parts)
