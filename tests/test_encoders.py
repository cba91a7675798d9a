import math

import pytest
from pyspark.sql import functions as F

from foldwise import operators as op
from tests.conftest import values

approx = pytest.approx


@pytest.fixture
def counted(frame):
    train = frame("id bigint, cat1 string, cat2 string", id=range(6), cat1=["A", "B", "A", "C", "B", None],
                  cat2=["X", "X", "Y", "Y", "Z", "X"])
    test = frame("id bigint, cat1 string, cat2 string", id=range(6, 10), cat1=["A", "B", "D", None],
                 cat2=["X", "Y", "W", "Z"])
    return train, test


def check_counts(train, test):
    cases = {
        "train": ([2, 2, 2, 1, 2, 0], [3, 3, 2, 2, 1, 3], [2, 2, 0, 0], [3, 2, 0, 1]),
        "test": ([1, 1, 1, 0, 1, 0], [1, 1, 1, 1, 1, 1], [1, 1, 1, 0], [1, 1, 1, 1]),
        "combined": ([3, 3, 3, 1, 3, 0], [4, 4, 3, 3, 2, 4], [3, 3, 1, 0], [4, 3, 1, 2]),
    }
    for source, want in cases.items():
        a, b = op.apply_count_encoding(train, ["cat1", "cat2"], test, count_on=source)
        got = (*values(a, "id", "cat1_count", "cat2_count"), *values(b, "id", "cat1_count", "cat2_count"))
        assert got == want, source


def test_counts(counted):
    check_counts(*counted)


def test_counts_on_large_routes(counted, big_data_routes):
    check_counts(*counted)


def test_counts_in_long_form(counted, big_data_routes):
    train, _ = counted
    out, _ = op.apply_count_encoding(train, ["cat1", "cat2"], row_id="id")
    assert values(out, "id", "cat1_count", "cat2_count") == [[2, 2, 2, 1, 2, 0], [3, 3, 2, 2, 1, 3]]


def test_frequencies_and_unknown(counted):
    train, test = counted
    a, b = op.apply_count_encoding(train, ["cat1", "cat2"], test, normalize=True)
    assert values(a, "id", "cat1_count") == approx([.4, .4, .4, .2, .4, 0])
    assert values(b, "id", "cat2_count") == approx([.5, 2 / 6, 0, 1 / 6])
    _, b = op.apply_count_encoding(train, ["cat1"], test, handle_unknown="nan")
    got = values(b, "id", "cat1_count")
    assert got[:2] == [2.0, 2.0] and all(math.isnan(v) for v in got[2:])
    with pytest.raises(ValueError):
        op.apply_count_encoding(train, ["cat1"], count_on="test")
    with pytest.raises(ValueError):
        op.apply_count_encoding(train, ["none"])


@pytest.fixture
def ratios(frame):
    schema = "id bigint, group string, value1 bigint, value2 double"
    train = frame(schema, id=range(8), group=["A", "B", "A", "C", "B", "A", "C", None],
                  value1=[10, 20, 12, 50, 22, None, 55, 30], value2=[1.0, 0.0, 0.5, 2.0, 0.0, 1.5, 2.5, 1.0])
    test = frame(schema, id=range(5), group=["A", "B", "D", "C", None], value1=[15, 25, 100, 60, 40],
                 value2=[0.8, 0.0, 5.0, 2.2, 1.2])
    return train, test


def check_ratios(train, test):
    names = ["value1_ratio_to_group_mean", "value2_ratio_to_group_mean"]
    a, b = op.apply_ratio_to_category_mean_encoding(train, ["value1", "value2"], "group", test)
    v1, v2 = values(a, "id", *names)
    assert v1 == approx([10 / 11, 20 / 21, 12 / 11, 50 / 52.5, 22 / 21, 1, 55 / 52.5, 1])
    assert v2 == approx([1, 1, .5, 2 / 2.25, 1, 1.5, 2.5 / 2.25, 1])
    v1, v2 = values(b, "id", *names)
    assert v1 == approx([15 / 11, 25 / 21, 1, 60 / 52.5, 40 / 30])
    assert v2 == approx([.8, 1, 1, 2.2 / 2.25, 1.2])
    a, b = op.apply_ratio_to_category_mean_encoding(train, ["value1"], "group", test, "combined")
    assert values(a, "id", names[0]) == approx([30 / 37, 60 / 67, 36 / 37, 50 / 55, 66 / 67, 1, 1, 30 / 35])
    assert values(b, "id", names[0]) == approx([45 / 37, 75 / 67, 1, 60 / 55, 40 / 35])
    a, _ = op.apply_ratio_to_category_mean_encoding(train, ["value2"], "group", fill_value=-999.0)
    assert values(a, "id", names[1])[1] == -999.0


def test_ratios(ratios):
    check_ratios(*ratios)


def test_ratios_on_large_routes(ratios, big_data_routes):
    check_ratios(*ratios)


@pytest.fixture
def small(frame):
    fold = [1] * 10
    for i in (0, 4, 6, 7, 8):
        fold[i] = 0
    return frame("id bigint, cat string, target bigint, fold int", id=range(10),
                 cat=["A", "B", "A", "B", "A", "C", "B", "A", "B", "A"],
                 target=[10, 20, 12, 22, 14, 50, 18, 11, 25, 15], fold=fold)


def fold0(df, cat):
    got = {r["cat_te"] for r in df.filter((F.col("fold") == 0) & (F.col("cat") == cat)).collect()}
    assert len(got) == 1
    return got.pop()


def check_target(small):
    raw = dict(features=["cat"], target="target", fold_col="fold", use_smoothing=False)
    mean, _ = op.apply_target_encoding(small, **raw)
    assert (fold0(mean, "A"), fold0(mean, "B")) == approx((13.5, 21.0))
    only_c = mean.filter((F.col("fold") == 1) & (F.col("cat") == "C")).first()["cat_te"]
    assert only_c == approx(15.6)
    median, _ = op.apply_target_encoding(small, agg_stat="median", **raw)
    assert (fold0(median, "A"), fold0(median, "B")) == approx((13.5, 21.0))
    p90, _ = op.apply_target_encoding(small, agg_stat="percentile", percentile=90, **raw)
    assert (fold0(p90, "A"), fold0(p90, "B")) == approx((14.7, 21.8))
    smooth, _ = op.apply_target_encoding(small, ["cat"], "target", "fold", smoothing=2.0)
    assert fold0(smooth, "A") == approx((2 * 13.5 + 2 * 23.8) / 4)


def test_target_encoding(small):
    check_target(small)


def test_target_encoding_on_large_routes(small, big_data_routes):
    check_target(small)


def test_target_encoding_of_new_rows(small, frame):
    test = frame("id bigint, cat string", id=[0, 1, 2], cat=["A", "Z", None])
    _, out = op.apply_target_encoding(small, ["cat"], "target", "fold", test, use_smoothing=False)
    overall = 197 / 10
    assert values(out, "id", "cat_te") == approx([62 / 5, overall, overall])


def test_own_target_never_counts(small):
    """Changing the targets of a fold must not change that fold's encoding."""
    before, _ = op.apply_target_encoding(small, ["cat"], "target", "fold")
    changed = small.withColumn("target", F.when(F.col("fold") == 0, F.col("target") * 100).otherwise(F.col("target")))
    after, _ = op.apply_target_encoding(changed, ["cat"], "target", "fold")
    pick = lambda df: values(df.filter("fold = 0"), "id", "cat_te")
    assert pick(before) == approx(pick(after))


def test_result_does_not_depend_on_partitions(small):
    want = None
    for n in (1, 7, 64):
        out, _ = op.apply_target_encoding(small.repartition(n), ["cat"], "target", "fold")
        got = values(out, "id", "cat_te")
        want = want or got
        assert got == approx(want)


def test_target_encoding_checks(small):
    with pytest.raises(ValueError):
        op.apply_target_encoding(small, ["cat"], "target", "fold", agg_stat="percentile")
    with pytest.raises(ValueError):
        op.apply_target_encoding(small, ["cat"], "target", "fold", agg_stat="max")
    with pytest.raises(ValueError):
        op.apply_target_encoding(small, ["absent"], "target", "fold")


@pytest.fixture
def categories(frame):
    train = frame("id bigint, cat1 string, cat2 string, num1 bigint", id=range(5), cat1=["A", "B", "A", "C", "B"],
                  cat2=["X", "Y", "X", "Y", "X"], num1=[1, 2, 3, 4, 5])
    test = frame("id bigint, cat1 string, cat2 string, num1 bigint", id=range(3), cat1=["A", "D", "C"],
                 cat2=["Y", "X", "X"], num1=[6, 7, 8])
    return train, test


def test_onehot(categories):
    train, test = categories
    a, b, model = op.encode_categorical_features(train, ["cat1", "cat2"], test, "onehot", drop_original=False)
    assert len(a.columns) == len(b.columns) == 4 + 5
    assert values(a, "id", "cat1_A") == [1, 0, 1, 0, 0]
    assert values(b, "id", "cat1_A", "cat1_B", "cat1_C") == [[1, 0, 0], [0, 0, 0], [0, 0, 1]]
    a, _, _ = op.encode_categorical_features(train, ["cat1"], encoder_type="onehot", new_col_prefix="oh_")
    assert "oh_cat1_A" in a.columns and "cat1" not in a.columns
    _, b, _ = op.encode_categorical_features(train, ["cat1"], test, "onehot", handle_unknown="error")
    with pytest.raises(Exception, match="unknown category"):
        b.collect()
    with pytest.raises(ValueError):
        op.encode_categorical_features(train, ["cat1"], encoder_type="hash")


def check_ordinal(train, test):
    a, b, _ = op.encode_categorical_features(train, ["cat1", "cat2"], test, "ordinal", handle_unknown="use_encoded_value")
    assert values(a, "id", "cat1") == [0, 1, 0, 2, 1]
    got = values(b, "id", "cat1")
    assert got[0] == 0 and math.isnan(got[1]) and got[2] == 2
    a, b, _ = op.encode_categorical_features(
        train, ["cat1"], test, "ordinal", "use_encoded_value", add_one=True, unknown_value=-1)
    assert (values(a, "id", "cat1"), values(b, "id", "cat1")) == ([1, 2, 1, 3, 2], [1, -1, 3])
    _, b, _ = op.encode_categorical_features(train, ["cat1"], test, "ordinal")
    with pytest.raises(Exception, match="unknown category"):
        b.collect()


def test_ordinal(categories):
    check_ordinal(*categories)


def test_ordinal_on_large_routes(categories, big_data_routes):
    check_ordinal(*categories)


def test_ordinal_numbers_sort_as_numbers(frame):
    df = frame("id int, n int", id=[0, 1, 2], n=[10, 9, 100])
    assert values(op.fit_ordinal(df, ["n"]).transform(df), "id", "n") == [1, 0, 2]


def test_bins(frame):
    train = frame("id int, x double, k string", id=range(6), x=[1., 2., 3., 4., 5., 6.], k=list("abcdef"))
    test = frame("id int, x double, k string", id=range(3), x=[0., 3.5, 9.], k=list("abc"))
    a, b, model = op.bin_and_encode_numerical_features(train, ["x"], 3, test)
    assert model.edges["x"] == [1.0, 3.0, 4.0, 6.0]
    names = model.names["x"]
    assert names == ["x_bin_1", "x_bin_2", "x_bin_3", "x_bin_4"] and "x" not in a.columns
    assert values(a, "id", "x_bin_4") == [0, 0, 0, 0, 0, 1]
    assert [sum(r[n] for n in names) for r in b.orderBy("id").collect()] == [0, 1, 1]
    uniform = op.fit_bins(train, ["x"], 5, "uniform")
    assert uniform.edges["x"] == approx([1, 2, 3, 4, 5, 6])
    constant = frame("x double", x=[2.0, 2.0])
    assert op.fit_bins(constant, ["x"], 3).edges["x"] == approx([2 - 2e-6, 2 + 2e-6])
    with pytest.raises(ValueError):
        op.fit_bins(train, ["x"], 3, "kmeans")
    with pytest.raises(TypeError):
        op.fit_bins(train, ["k"], 3)


def test_bins_on_large_routes(frame, big_data_routes):
    train = frame("x double", x=[1., 2., 3., 4., 5., 6.])
    assert op.fit_bins(train, ["x"], 3).edges["x"] == [1.0, 3.0, 4.0, 6.0]
