import pytest

from sluice.plans.query import FilterError, QueryFilter, scanned_path


def test_defaults():
    f = QueryFilter()
    assert (f.prefix, f.page, f.page_size, f.max_rows) == ("data", 1, 100, 10_000)
    assert f.year is f.month is f.day is f.hour is f.source is f.additional_where is None
    assert (f.limit, f.offset) == (100, 0)


def test_every_parameter_is_taken_over():
    f = QueryFilter.of(prefix="quarantine", year="2026", month="7", day="1", hour="0",
                       source="cloud", additional_where="quality_score < 0.6", max_rows="50",
                       page="3", page_size="200")
    assert (f.year, f.month, f.day, f.hour) == (2026, 7, 1, 0)
    assert f.limit == 50 and f.offset == 100


@pytest.mark.parametrize("field,value", [
    ("month", 13), ("month", 0), ("year", 1999), ("year", 2101), ("day", 32), ("hour", 24),
    ("hour", -1), ("page", 0), ("page_size", 0), ("page_size", 999_999), ("max_rows", 0),
    ("max_rows", 100_001), ("prefix", "  "), ("month", "july"), ("colour", 1)])
def test_bad_values_name_their_field(field, value):
    with pytest.raises(FilterError) as e:
        QueryFilter.of(**{field: value})
    assert list(e.value.errors) == [field]
    assert field in str(e.value)


def test_all_bad_fields_are_listed():
    with pytest.raises(FilterError) as e:
        QueryFilter(month=13, year=1999, page=0)
    assert set(e.value.errors) == {"month", "year", "page"}


def test_limit_is_the_smallest_bound():
    assert QueryFilter(page_size=10_000, max_rows=100_000).limit == 10_000
    assert QueryFilter(page_size=500, max_rows=20).limit == 20


def test_scanned_path_goes_as_deep_as_the_levels_are_set():
    assert scanned_path("/lake", QueryFilter()) == "/lake/data"
    assert scanned_path("/lake", QueryFilter(month=7)) == "/lake/data"
    assert scanned_path("/lake", QueryFilter(year=2026, month=7)) == "/lake/data/year=2026/month=07"
    deep = QueryFilter(year=2026, month=7, day=1, hour=5, source="cloud")
    assert scanned_path("/lake/", deep) == "/lake/data/year=2026/month=07/day=01/hour=05/source=cloud"
