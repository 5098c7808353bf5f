"""Rate plans whose options share a number."""

from matchloom.operators import unions


def test_order_of_rows_does_not_matter(spark):
    schema = "hotel_id long, option_seq long, title string, rooms array<struct<name:string,max_occupancy:int>>"
    rows = [(1, 5, "t", [("King", n)]) for n in (4, 2, 3)]
    for given in (rows, rows[::-1], rows[1:] + rows[:1]):
        assert [x.max_occupancy for x in unions.collapse_rate_plans(spark.createDataFrame(given, schema).coalesce(1)).collect()] == [2]
