"""Grid joins of the layout against plain loops over all pairs."""

import random

from folioforge.operators import layout

BOX = "page long, box_id long, x0 long, y0 long, x1 long, y1 long, hint string, role string"
REGION = "page long, det_id long, x0 long, y0 long, x1 long, y1 long, label string, confidence double"


def _boxes(rng, n):
    out = []
    for i in range(n):
        x, y = rng.randint(0, 500), rng.randint(0, 700)
        out.append((rng.choice((1, 1, 1, 2)), i, x, y, x + rng.choice((0, 5, 90, 300)), y + rng.choice((0, 9, 130, 128)), rng.choice(("Figure 3: words", "body text", "Table 1")), "body"))
    return out


def _iou(a, b):
    w, h = min(a[4], b[4]) - max(a[2], b[2]), min(a[5], b[5]) - max(a[3], b[3])
    area = lambda r: max(0, r[4] - r[2]) * max(0, r[5] - r[3])
    union = area(a) + area(b) - w * h
    return 0.0 if w <= 0 or h <= 0 or union <= 0 else w * h / union


def test_overlaps_and_assignment(spark):
    rng = random.Random(3)
    boxes = _boxes(rng, 120)
    regions = [(*r[:6], rng.choice("ab"), 0.5) for r in _boxes(rng, 60)]
    b, r = spark.createDataFrame(boxes, BOX), spark.createDataFrame(regions, REGION)
    pairs = {(x[0], x[1], y[1]): round(_iou(x, y), 9) for x in boxes for y in regions if x[0] == y[0] and _iou(x, y) > 0}
    got = layout.overlaps(spark, boxes=b, regions=r).collect()
    assert len(got) == len(pairs) > 50 and {(g.page, g.box_id, g.det_id): g.overlap for g in got} == pairs
    best = {}
    for x in boxes:
        met = sorted((-_iou(x, y), y[1], y[6]) for y in regions if x[0] == y[0] and _iou(x, y) > 0)
        best[x[1]] = (met[0][2], round(-met[0][0], 9)) if met else ("unassigned", 0.0)
    assert {g.box_id: (g.label, g.overlap) for g in layout.assign(spark, boxes=b, regions=r).collect()} == best


def test_crops(spark):
    boxes = _boxes(random.Random(5), 150)
    want = {}
    for c in boxes:
        if c[6] == "body text":
            continue
        wide, left = (c[4] - c[2]) * 100 >= 600 * 55, (c[2] + c[4]) / 2 < 300
        lx, rx = 18 if wide or left else 308, 582 if wide or not left else 292
        over = [b for b in boxes if b[0] == c[0] and b[1] != c[1] and b[4] >= lx and b[2] <= rx and c[3] - 180 < b[5] <= c[3] + 2]
        x0, y0, x1 = (min(b[2] for b in over), min(b[3] for b in over) - 6, max(b[4] for b in over)) if over else (lx, c[3] - 220, rx)
        want[c[1]] = (max(0, min(lx, x0)), max(0, y0), min(600, max(rx, x1)), c[5] + 10)
    got = {g.box_id: (g.x0, g.y0, g.x1, g.y1) for g in layout.crops()(spark, boxes=spark.createDataFrame(boxes, BOX)).collect()}
    assert got == want and len(got) > 50
