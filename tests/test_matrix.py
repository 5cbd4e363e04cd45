from minekit.operators.matrix import matrix_product, ordered_cells, select_matrix


def cells(spark, rows):
    return spark.createDataFrame(rows, "i bigint, j bigint, v bigint")


def result(df):
    return [tuple(r) for r in ordered_cells(df).collect()]


def test_two_by_two(spark):
    m = cells(spark, [(0, 0, 1), (0, 1, 2), (1, 0, 3), (1, 1, 4)])
    n = cells(spark, [(0, 0, 5), (0, 1, 6), (1, 0, 7), (1, 1, 8)])
    assert result(matrix_product(m, n)) == [(0, 0, 19), (0, 1, 22), (1, 0, 43), (1, 1, 50)]


def test_identity_keeps_the_matrix(spark):
    m = cells(spark, [(0, 3, 9), (2, 1, -4), (5, 5, 7)])
    one = cells(spark, [(d, d, 1) for d in range(6)])
    assert result(matrix_product(m, one)) == [(0, 3, 9), (2, 1, -4), (5, 5, 7)]


def test_zero_sum_cell_stays_and_unmatched_index_is_absent(spark):
    m = cells(spark, [(0, 0, 1), (0, 1, 1), (1, 9, 5)])
    n = cells(spark, [(0, 0, 2), (1, 0, -2)])
    assert result(matrix_product(m, n)) == [(0, 0, 0)]


def test_repeated_entries_add_up(spark):
    m = cells(spark, [(0, 0, 1), (0, 0, 2)])
    n = cells(spark, [(0, 0, 10), (0, 0, 100)])
    assert result(matrix_product(m, n)) == [(0, 0, 330)]


def test_hot_index_in_blocks(spark):
    m = cells(spark, [(i, 0, i) for i in range(60)] + [(i, i % 5, 1) for i in range(30)])
    n = cells(spark, [(0, k, k + 1) for k in range(40)] + [(k % 5, k, 2) for k in range(10)])
    assert result(matrix_product(m, n, block_cost=30)) == result(matrix_product(m, n))


def test_name_is_compared_whole(spark):
    rows = spark.createDataFrame([("M", 0, 0, 1), ("MN", 1, 1, 1)], "name string, i bigint, j bigint, v bigint")
    assert select_matrix(rows, "M").count() == 1
