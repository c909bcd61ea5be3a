import datetime as dt

import pytest

from strata.params import parse_slices, slice_bounds


def test_parse_slices_sorts_and_dedupes():
    assert parse_slices(" 2025-01, 2024-12,2025-01 ") == ["2024-12", "2025-01"]


@pytest.mark.parametrize("bad", ["2025-13", "", "2025-1", "2025-01,x"])
def test_parse_slices_rejects(bad):
    with pytest.raises(ValueError):
        parse_slices(bad)


def test_slice_bounds_include_gaps():
    assert slice_bounds(["2024-12", "2025-02"]) == (dt.date(2024, 12, 1), dt.date(2025, 2, 28))
