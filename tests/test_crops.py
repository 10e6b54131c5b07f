from folioforge.operators import layout

ROWS = [(1, 7, 10, 300, 200, 320, "Body text", "body"), (1, 8, 10, 400, 200, 420, "Figure 1: An overview", "body"), (1, 9, 10, 500, 200, 520, "Table 2: Counts", "body"), (1, 14, 10, 350, 200, 390, "More text", "caption")]
SCHEMA = "page long, box_id long, x0 long, y0 long, x1 long, y1 long, hint string, role string"


def test_all_captions_get_a_crop_and_nothing_else(spark):
    boxes = spark.createDataFrame(ROWS, SCHEMA)
    assert {r.box_id for r in layout.crops()(spark, boxes=boxes).collect()} == {8, 9}
    assert {r.box_id for r in layout.crops(lambda d: "role = 'caption'")(spark, boxes=boxes).collect()} == {14}
