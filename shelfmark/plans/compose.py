"""Joins drawn on a canvas, as SQL: what can be linked, and the statement for a selection."""

from __future__ import annotations

from dataclasses import dataclass

#: Columns that many tables share without meaning the same.
NEVER = frozenset("name date day price qty source url created_at updated_at _source".split())
KINDS = ("INNER", "LEFT", "RIGHT", "FULL")


@dataclass(frozen=True)
class Link:
    left: str
    right: str
    on: tuple[tuple[str, str], ...]
    why: str


def links(tables: dict[str, list[str]], declared: list[tuple[str, str, list[tuple[str, str]]]] = [], identity: tuple[str, ...] = ("id", "key", "upc", "gtin")) -> list[Link]:
    """Ways to join tables: declared keys first, then shared identity columns, then other shared names."""
    out = [Link(a, b, tuple(map(tuple, on)), "declared") for a, b, on in declared if a in tables and b in tables]
    have = {frozenset((x.left, x.right)) for x in out}
    names = sorted(tables)
    for i, a in enumerate(names):
        for b in names[i + 1 :]:
            if frozenset((a, b)) in have:
                continue
            shared = [c for c in tables[a] if c in tables[b] and c not in NEVER]
            keys = [c for c in shared if any(c == k or c.endswith(f"_{k}") for k in identity)]
            if keys or shared:
                out.append(Link(a, b, tuple((c, c) for c in keys or shared[:1]), "identity" if keys else "shared name"))
    return out


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def build_sql(tables: dict[str, list[str]], joins: list[dict], columns: dict[str, list[str]], limit: int | None = None) -> str:
    """SQL of a selection. joins: left, right, on, kind. A graph that does not hang together is refused: it would be a
    product. A column whose name another table has too is called <table>_<column>."""
    wanted = [t for t in tables if t in columns or any(t in (j["left"], j["right"]) for j in joins)]
    if not wanted:
        raise ValueError("nothing is selected")
    order, rest, text = [wanted[0]], list(joins), f"FROM {quote(wanted[0])}"
    while rest:
        j = next((x for x in rest if (x["left"] in order) != (x["right"] in order)), None)
        if j is None:
            if any(x["left"] not in order for x in rest):
                break
            raise ValueError("two joins bring in the same table")
        kind = j.get("kind", "INNER").upper()
        if kind not in KINDS:
            raise ValueError(f"no such join: {kind}")
        turned = j["right"] in order
        new = j["left"] if turned else j["right"]
        if turned:
            kind = {"LEFT": "RIGHT", "RIGHT": "LEFT"}.get(kind, kind)
        on = " AND ".join(f"{quote(j['left'])}.{quote(a)} = {quote(j['right'])}.{quote(b)}" for a, b in j["on"])
        if not on:
            raise ValueError(f"{j['left']} and {j['right']} have no key")
        text += f" {kind} JOIN {quote(new)} ON {on}"
        order.append(new)
        rest.remove(j)
    if missing := [t for t in wanted if t not in order]:
        raise ValueError(f"not joined to the rest: {', '.join(missing)}")
    seen: dict[str, int] = {}
    for t in order:
        for c in columns.get(t, []):
            seen[c] = seen.get(c, 0) + 1
    listed = [f"{quote(t)}.{quote(c)}" + (f" AS {quote(f'{t}_{c}')}" if seen[c] > 1 else "") for t in order for c in columns.get(t, [])]
    return f"SELECT {', '.join(listed) or '*'} {text}" + (f" LIMIT {int(limit)}" if limit else "")
