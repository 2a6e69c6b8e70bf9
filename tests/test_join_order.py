"""Which columns travel for which join."""

from checks.exports import erp
from quayside.operators import export


def test_columns_of_orders_do_not_shuffle_for_the_product(spark, sf_dir):
    for variant in ("18", "19"):
        plan = export("sale_order_line", erp(spark, sf_dir, variant))._jdf.queryExecution().optimizedPlan().toString()
        joins = [line for line in plan.splitlines() if "Join Inner" in line]
        order, product = (next(i for i, j in enumerate(joins) if f"({key}#" in j) for key in ("order_id", "product_id"))
        assert order < product  # the upper join comes last
