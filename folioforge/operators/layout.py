"""Layout: overlap of boxes, assignment of text blocks to regions, reading order, crops.

Joins are by page and by cells of a grid laid over it, so a box only meets what
lies near it on its own page, and a page that holds very many boxes is many keys.
"""

from __future__ import annotations

from collections.abc import Callable

from ..functions import assembly
from ..functions.dialect import Dialect
from .template import Operator


def iou(d: Dialect, a: str, b: str) -> str:
    """Intersection over union of boxes (x0, y0, x1, y1); 0 where they are apart or degenerate."""
    w = f"least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)"
    h = f"least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)"
    area = lambda r: f"greatest(0, {r}.x1 - {r}.x0) * greatest(0, {r}.y1 - {r}.y0)"
    union = f"({area(a)} + {area(b)} - ({w}) * ({h}))"
    return f"CASE WHEN {w} <= 0 OR {h} <= 0 OR {union} <= 0 THEN {d.double('0')} ELSE {d.double(f'({w}) * ({h})')} / {union} END"


def column(width: int, x0: str, x1: str, side: str, margin: int = 18, gutter: int = 8) -> str:
    """Left or right limit of the column a caption stands in; wide ones take the page."""
    wide = f"({x1} - {x0}) * 100 >= {width} * 55"
    left = f"({x0} + {x1}) * 1.0 / 2 < {width / 2}"
    if side == "left":
        return f"CASE WHEN {wide} OR {left} THEN {margin} ELSE {width // 2 + gutter} END"
    return f"CASE WHEN {wide} OR NOT {left} THEN {width - margin} ELSE {width // 2 - gutter} END"


CELL = 128


def _in_cells(d: Dialect, table: str, cell: int = CELL) -> str:
    """table with a row for each grid cell that a box covers: also cx, cy."""
    each = "explode(sequence({0}, {1}))" if d.name == "spark" else "unnest(range({0}, {1} + 1))"
    span = lambda a, z: each.format(f"CAST(floor({a} / {cell}) AS BIGINT)", f"CAST(floor({z} / {cell}) AS BIGINT)")
    solid = f"(SELECT * FROM {table} WHERE x0 < x1 AND y0 < y1)"
    return f"(SELECT *, {span('y0', 'y1')} AS cy FROM (SELECT *, {span('x0', 'x1')} AS cx FROM {solid}))"


def met(d: Dialect) -> str:
    """CTE met (page, box_id, det_id, label, confidence, overlap): boxes and regions of a page that overlap. A pair counts in the cell where its common part begins, so it comes once."""
    begins = lambda a: f"CAST(floor(greatest(t.{a}, r.{a}) / {CELL}) AS BIGINT)"
    return (
        f"met AS (SELECT t.page, t.box_id, r.det_id, r.label, r.confidence, {iou(d, 't', 'r')} AS overlap FROM {_in_cells(d, '@boxes@')} t JOIN {_in_cells(d, '@regions@')} r"
        f" ON t.page = r.page AND t.cx = r.cx AND t.cy = r.cy AND t.x0 < r.x1 AND r.x0 < t.x1 AND t.y0 < r.y1 AND r.y0 < t.y1 AND t.cx = {begins('x0')} AND t.cy = {begins('y0')})"
    )


overlaps = Operator(lambda d: f"WITH {met(d)} SELECT page, box_id, det_id, round(overlap, 9) AS overlap FROM met")

#: Every text box with the region it overlaps most (the first one among equals), or none.
assign = Operator(
    lambda d: f"WITH {met(d)}, best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY page, box_id ORDER BY overlap DESC, det_id) AS rn FROM met WHERE overlap > 0) WHERE rn = 1)"
    f" SELECT t.page, t.box_id, coalesce(b.label, 'unassigned') AS label, coalesce(b.confidence, {d.double('0')}) AS confidence, round(coalesce(b.overlap, {d.double('0')}), 9) AS overlap FROM @boxes@ t LEFT JOIN best b ON t.page = b.page AND t.box_id = b.box_id"
)

reading_order = Operator(lambda d: "SELECT page, box_id, CAST(row_number() OVER (PARTITION BY page ORDER BY y0, x0, box_id) AS BIGINT) AS place FROM @boxes@")
unions = Operator(lambda d: "SELECT page, min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1 FROM @boxes@ GROUP BY page")
smallest = Operator(lambda d: "SELECT page, box_id, area FROM (SELECT page, box_id, (x1 - x0) * (y1 - y0) AS area, row_number() OVER (PARTITION BY page ORDER BY (x1 - x0) * (y1 - y0), box_id) AS rn FROM @boxes@) WHERE rn = 1")
columns = Operator(lambda d: f"SELECT page, box_id, CAST({column(600, 'x0', 'x1', 'left')} AS BIGINT) AS from_x, CAST({column(600, 'x0', 'x1', 'right')} AS BIGINT) AS to_x FROM @boxes@")

#: How far above a caption its figure may stand, and the height of the bands in which boxes are sought.
ABOVE, BAND = 180, 182
CAPTION = r"^\s*(?:Figure|Fig\.|Table)\s+[0-9]+"


def is_caption(d: Dialect) -> str:
    return d.rx("hint", CAPTION)


def crops(caption: Callable[[Dialect], str] = is_caption) -> Operator:
    """What stands above a caption in its column: the union of these boxes, widened to the column, or a default height. caption: which boxes are captions, by their text unless the caller has a column that says so."""
    band = lambda y: f"CAST(floor(({y}) / {BAND}) AS BIGINT)"

    def sql(d: Dialect) -> str:
        each = f"{'explode(sequence' if d.name == 'spark' else 'unnest(range'}({band(f'y0 - {ABOVE}')}, {band('y0 + 2')}{')' if d.name == 'spark' else ' + 1)'})"
        return (
            f"WITH c AS (SELECT page, box_id, y0, y1, {column(600, 'x0', 'x1', 'left')} AS lx, {column(600, 'x0', 'x1', 'right')} AS rx FROM @boxes@ WHERE {caption(d)}),"
            f" near AS (SELECT *, {each} AS band FROM c), b AS (SELECT page, box_id, x0, y0, x1, y1, {band('y1')} AS band FROM @boxes@),"
            f" u AS (SELECT c.page, c.box_id, min(b.x0) AS x0, min(b.y0) AS y0, max(b.x1) AS x1 FROM near c JOIN b ON b.page = c.page AND b.band = c.band AND b.box_id <> c.box_id AND b.x1 >= c.lx AND b.x0 <= c.rx AND b.y1 <= c.y0 + 2 AND b.y1 > c.y0 - {ABOVE} GROUP BY c.page, c.box_id)"
            " SELECT c.page, c.box_id, CAST(greatest(0, coalesce(least(c.lx, u.x0), c.lx)) AS BIGINT) AS x0, CAST(greatest(0, coalesce(u.y0 - 6, c.y0 - 220)) AS BIGINT) AS y0, CAST(least(600, coalesce(greatest(c.rx, u.x1), c.rx)) AS BIGINT) AS x1, CAST(c.y1 + 10 AS BIGINT) AS y1"
            " FROM c LEFT JOIN u ON u.page = c.page AND u.box_id = c.box_id"
        )

    return Operator(sql)


def _layout_document(d: Dialect) -> str:
    t = assembly.one_line(d, "hint")
    level = f"CASE WHEN {d.in_('t', ('Abstract', 'References'))} THEN 2 WHEN {d.rx('t', r'^[0-9]+\s+\S')} THEN 2 WHEN {d.rx('t', r'^[0-9]+\.[0-9]+\s+\S')} THEN 3 WHEN {d.rx('t', r'^[A-Z]\s+\S')} THEN 2 END"
    shown = f"CASE WHEN role = 'title' AND ({level}) IS NOT NULL THEN concat(repeat('#', {level}), ' ', t) ELSE t END"
    if d.name == "spark":
        joined = f"array_join(transform(array_sort(collect_list(struct(y0, x0, box_id, s))), e -> e.s), {d.text(chr(10) * 2)})"
    else:
        joined = f"string_agg(s, {d.text(chr(10) * 2)} ORDER BY y0, x0, box_id)"
    return f"SELECT page, count(*) AS n, md5({joined}) AS document_hash FROM (SELECT *, {shown} AS s FROM (SELECT *, {t} AS t FROM @boxes@) WHERE t <> '' AND role <> 'noise') GROUP BY page"


#: Regions as Markdown in reading order, without noise and empty ones.
render = Operator(_layout_document)
