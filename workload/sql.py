"""SQL pieces the twins share: the stand-in tables as common table expressions."""

from __future__ import annotations

import re
from collections.abc import Iterable

from workload.standin import (
    AGES,
    CHANGES_SQL,
    CODE_PREFIX,
    COUNTRY_CODE,
    CUTOVER,
    NEW_VINTAGE,
    OLD_VINTAGE,
    REGION_CODE,
    case,
)


def _sheet_cells(fill: bool) -> str:
    cells = (f"sum(value) FILTER (WHERE age = {a})" for a in AGES)
    return ", ".join(f'coalesce({c}, 0) AS "Age_{a}"' if fill else f'{c} AS "Age_{a}"' for a, c in zip(AGES, cells))


def _sheet(fill: bool) -> str:
    return (
        f'SELECT gss_out AS outla, gss_in AS inla, sex AS "Sex", year AS "Year", {_sheet_cells(fill)} '
        "FROM od_flows GROUP BY gss_out, gss_in, sex, year"
    )


def _lads(target: str) -> str:
    return f"SELECT lad_code, {target} FROM lads WHERE {target} IS NOT NULL"


CTES = {
    "nations": f"""
        SELECT n_nationkey, n_regionkey, n_name,
               {case("n_regionkey", CODE_PREFIX)} || lpad(CAST(n_nationkey AS VARCHAR), 6, '0') AS code
        FROM nation""",
    "od_flows": """
        SELECT o.code AS gss_out, i.code AS gss_in,
               CASE l_returnflag WHEN 'A' THEN 'F' WHEN 'R' THEN 'M' ELSE 'X' END AS sex,
               CAST(year(l_shipdate) AS INTEGER) AS year, CAST(l_linenumber AS INTEGER) AS age,
               sum(CAST(l_quantity AS DOUBLE)) AS value
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
        JOIN nations o ON o.n_nationkey = c_nationkey
        JOIN nations i ON i.n_nationkey = s_nationkey
        GROUP BY 1, 2, 3, 4, 5""",
    "flows": """
        SELECT gss_out, gss_in, CASE sex WHEN 'F' THEN 'female' WHEN 'M' THEN 'male' END AS sex, year, age, value
        FROM od_flows""",
    "sheet": _sheet(fill=True),
    "sheet_gaps": _sheet(fill=False),
    "lads": f"""
        SELECT code AS lad_code, {case("n_regionkey", REGION_CODE)} AS region_code,
               {case("n_regionkey", COUNTRY_CODE)} AS country_code,
               CASE WHEN n_regionkey = 0 AND n_nationkey % 2 = 0 THEN 'E13000001'
                    WHEN n_regionkey = 0 THEN 'E13000002' ELSE 'other' END AS io_london
        FROM nations""",
    "region_lookup": _lads("region_code"),
    "country_lookup": _lads("country_code"),
    "inner_outer_lookup": _lads("io_london"),
    "changes": CHANGES_SQL,
}


def _closure(edges: str, years: Iterable[int], prefix: str) -> dict[str, str]:
    """One expression per year: add its changes, then move targets on once."""
    ctes = {}
    previous = None
    for year in years:
        of_year = f"SELECT f, t FROM ({edges}) WHERE y = {year}"
        starts = of_year if previous is None else f"SELECT f, t FROM {previous} UNION ALL {of_year}"
        previous = f"{prefix}_{year}"
        ctes[previous] = f"SELECT s.f, coalesce(e.t, s.t) AS t FROM ({starts}) s LEFT JOIN ({of_year}) e ON s.t = e.f"
    ctes[f"{prefix}_pairs"] = f"SELECT f AS changed_from_code, t AS changed_to_code FROM {previous}"
    ctes[f"{prefix}_distinct"] = f"SELECT DISTINCT * FROM {prefix}_pairs WHERE changed_from_code <> changed_to_code"
    ctes[f"{prefix}_lookup"] = (
        "SELECT changed_from_code, string_agg(DISTINCT changed_to_code, ', ' ORDER BY changed_to_code) "
        f"AS changed_to_code FROM {prefix}_distinct GROUP BY changed_from_code"
    )
    return ctes


CTES |= _closure(
    "SELECT changed_from_code AS f, changed_to_code AS t, year AS y FROM changes",
    range(OLD_VINTAGE, NEW_VINTAGE + 1),
    "forward",
)
CTES |= _closure(
    "SELECT changed_to_code AS f, changed_from_code AS t, year - 1 AS y FROM changes",
    range(NEW_VINTAGE, OLD_VINTAGE - 1, -1),
    "reverse",
)


def _uses(text: str, name: str) -> int:
    return len(re.findall(rf"\b{name}\b", text))


def with_tables(body: str, **extra: str) -> str:
    """``body`` behind the expressions it needs; those used more than once are evaluated once."""
    known = CTES | extra
    needed, open_ends = set(), [body]
    while open_ends:
        text = open_ends.pop()
        for name in known:
            if name not in needed and _uses(text, name):
                needed.add(name)
                open_ends.append(known[name])
    texts = [body, *(known[name] for name in needed)]
    parts = []
    for name in known:
        if name in needed:
            once = "" if sum(_uses(t, name) for t in texts) < 2 else "MATERIALIZED "
            parts.append(f"{name} AS {once}({known[name]})")
    return f"WITH {', '.join(parts)} {body}" if parts else body


def recoded(source: str, column: str, aggregate: str | None = "sum") -> str:
    """``source`` with one code column carried forward."""
    new = f"coalesce(l.changed_to_code, s.{column}) AS {column}"
    keys = ["gss_out", "gss_in", "sex", "year", "age"]
    columns = ", ".join(new if k == column else f"s.{k}" for k in keys)
    base = f"SELECT {columns}, s.value FROM ({source}) s LEFT JOIN forward_lookup l ON s.{column} = l.changed_from_code"
    if aggregate is None:
        return base
    present = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return (
        f"SELECT {', '.join(keys)}, {aggregate}(value) AS value FROM ({base}) WHERE {present} GROUP BY {', '.join(keys)}"
    )


def recoded_end(source: str, column: str) -> str:
    """``recoded`` for the codes holding the pattern, the other rows as they are."""
    hit = f"coalesce(regexp_matches({column}, 'E0|W0'), false)"
    return (
        f"{recoded(f'SELECT * FROM {source} WHERE {hit}', column)} "
        f"UNION ALL SELECT gss_out, gss_in, sex, year, age, value FROM {source} WHERE NOT {hit}"
    )


HISTORICAL = {
    "historical": f"SELECT * FROM flows WHERE year < {CUTOVER}",
    "historical_in": recoded_end("historical", "gss_in"),
    "historical_both": recoded_end("historical_in", "gss_out"),
}

UNPIVOTED = f"""
        SELECT * FROM (SELECT outla AS gss_out, inla AS gss_in,
               CASE "Sex" WHEN 'F' THEN 'female' WHEN 'M' THEN 'male' END AS sex, "Year" AS year,
               unnest([{', '.join(map(str, AGES))}]) AS age, unnest([{', '.join(f'"Age_{age}"' for age in AGES)}]) AS value
        FROM sheet WHERE "Year" >= {CUTOVER}) WHERE value <> 0"""


def gross(source: str, where: str = "true") -> str:
    return f"""
        SELECT * FROM (SELECT coalesce(i.gss_code, o.gss_code) AS gss_code, coalesce(i.year, o.year) AS year,
               round_even(coalesce(inflow, 0), 1) AS inflow, round_even(coalesce(outflow, 0), 1) AS outflow
        FROM (SELECT gss_in AS gss_code, year, sum(value) AS inflow FROM {source} GROUP BY 1, 2) i
        FULL OUTER JOIN (SELECT gss_out AS gss_code, year, sum(value) AS outflow FROM {source} GROUP BY 1, 2) o
          ON i.gss_code = o.gss_code AND i.year = o.year) WHERE {where}"""


def areas(lookup: str, target: str, keys: str = "year", where: str = "true") -> str:
    return f"""
        SELECT i.{target} AS gss_in, o.{target} AS gss_out, {keys}, sum(value) AS value
        FROM flows JOIN {lookup} i ON gss_in = i.lad_code JOIN {lookup} o ON gss_out = o.lad_code
        WHERE {where} GROUP BY i.{target}, o.{target}, {keys}"""
