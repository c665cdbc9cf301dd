"""Reference SQL for a wide extract: plain joins, for comparison only."""

from __future__ import annotations

from recordflow.plans.wide import Bridge, Field, WideSpec


def _value(f: Field) -> str:
    source = f"CAST({f.sources[0]} AS VARCHAR)"
    return f"'{f.value}' || {source}" if f.value else source


def _render(f: Field, member: str) -> str:
    cast = [f"CAST({s} AS VARCHAR)" for s in f.sources]
    if f.kind in ("flag", "flag_ci"):
        if f.kind == "flag_ci":
            cast = [f"lower({c})" for c in cast]
        return f"CASE WHEN {cast[0]} IN ('1', 'true') THEN 'Sim' WHEN {cast[0]} IN ('0', 'false') THEN 'Não' ELSE '' END"
    if f.kind == "text":
        return f"coalesce({cast[0]}, '')"
    if f.kind == "merge":
        return "coalesce(" + ", ".join(f"nullif({c}, '')" for c in cast) + ", '')"
    if f.kind == "merge_number":
        return "coalesce(" + ", ".join(cast) + ", '')"
    if f.kind == "const":
        return f"'{f.value}'"
    return member if f.kind == "members" else f.sources[0]


def _joins(spec: WideSpec, link_sql) -> str:
    """LEFT JOINs with parents before their children."""
    done, lines, waiting = {spec.alias}, [], list(spec.links)
    while waiting:
        link = next(x for x in waiting if x.parent in done)
        waiting.remove(link)
        done.add(link.alias)
        lines.append(link_sql(link))
    return "\n".join(lines)


def _plain(link) -> str:
    on = f"{link.parent}.{link.on}"
    if isinstance(link, Bridge):
        return (
            f"LEFT JOIN {link.table} {link.alias}_ids ON {link.alias}_ids.{link.key} = {on} "
            f"LEFT JOIN {link.target} {link.alias} ON {link.alias}.{link.target_key} = {link.alias}_ids.{link.target_key}"
        )
    return f"LEFT JOIN {link.table} {link.alias} ON {link.alias}.{link.key} = {on}"


def _where(spec: WideSpec) -> str:
    return (
        "WHERE CAST(ta.ic_publicado_internet AS VARCHAR) IN ('1', 'true') AND (ta.id_situacao IS NULL OR ta.id_situacao <> 2)"
        if spec.where is not None else ""
    )


def naive_sql(spec: WideSpec) -> str:
    """All joins first, one GROUP BY over every raw column after."""
    keys = list(dict.fromkeys(s for f in spec.fields if f.kind != "members" for s in f.sources))
    columns = []
    for f in spec.fields:
        member = f"coalesce(string_agg(DISTINCT {_value(f)}, '||' ORDER BY {_value(f)}), '')" if f.kind == "members" else ""
        columns.append(f"{_render(f, member)} AS {f.name}")
    return (
        f"SELECT {', '.join(columns)} FROM {spec.table} {spec.alias}\n{_joins(spec, _plain)}\n"
        f"{_where(spec)} GROUP BY {', '.join(keys)}"
    )
