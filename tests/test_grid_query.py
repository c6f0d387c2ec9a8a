"""The query over rounds meets what other tasks wrote without shuffling its rows."""

from showcase.patterns import relationships_grid


def test_rows_are_not_shuffled_to_be_compared(spark, sf, capsys):
    frame = relationships_grid(spark, sf)
    assert frame.where("shared <> 0").isEmpty() and frame.count() == 6000
    frame.explain()
    assert "Exchange hashpartitioning" not in capsys.readouterr().out
