"""Name -> query function. Each takes (spark, source folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import behaviour, cohorts, payments, sales, segments, trends

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {
    # sales database
    "distinct_places": sales.distinct_places,                                  # Q01
    "heaviest_products": sales.heaviest_products,                              # Q02
    "products_by_color_or_size": sales.products_by_color_or_size,              # Q03
    "products_by_number_pattern": sales.products_by_number_pattern,            # Q04
    "products_never_ordered": sales.products_never_ordered,                    # Q05
    "customer_orders": sales.customer_orders,                                  # Q06
    "customer_orders_main_address": sales.customer_orders_main_address,        # Q07
    "product_name_prefix": sales.product_name_prefix,                          # Q08
    # payments star
    "transactions_not_type": payments.transactions_not_type,                   # Q09
    "transactions_by_channel": payments.transactions_by_channel,               # Q10
    "transactions_two_januaries": payments.transactions_two_januaries,         # Q11
    "returning_customer_transactions": payments.returning_customer_transactions,  # Q12
    "share_by_type_top5": behaviour.share_by_type_top5,                        # Q13
    "share_of_category_in_type": behaviour.share_of_category_in_type,          # Q14
    "top_customers_metrics": behaviour.top_customers_metrics,                  # Q15
    "metric_summary": behaviour.metric_summary_report,                         # Q16
    "hist_amount": behaviour.hist_amount,                                      # Q17
    "hist_trans": behaviour.hist_trans,                                        # Q18
    "hist_categories": behaviour.hist_categories,                              # Q19
    "hist_scenarios": behaviour.hist_scenarios,                                # Q20
    "monthly_trend": trends.monthly_trend,                                     # Q21
    "monthly_trend_by_sub": trends.monthly_trend_by_sub,                       # Q22
    "monthly_pivot": trends.monthly_pivot,                                     # Q23
    "monthly_pivot_case": trends.monthly_pivot_case,                           # Q24
    "monthly_share": trends.monthly_share,                                     # Q25
    "index_to_first_month": trends.index_to_first_month,                       # Q26
    "month_year_labels": trends.month_year_labels,                             # Q27
    "weekly_running_customers": trends.weekly_running_customers,               # Q29
    "weekly_moving_average": trends.weekly_moving_average,                     # Q30
    "year_over_year": trends.year_over_year,                                   # Q31
    "retention_first_cohort": cohorts.retention_first_cohort,                  # Q32
    "retention_first_cohort_pct": cohorts.retention_first_cohort_pct,          # Q33
    "retention_all_cohorts_join": cohorts.retention_all_cohorts_join,          # Q34
    "retention_all_cohorts": cohorts.retention_all_cohorts,                    # Q35
    "retention_matrix_join": cohorts.retention_matrix_join,                    # Q36
    "retention_matrix": cohorts.retention_matrix,                              # Q37
    "rfm_segments": segments.rfm_segments,                                     # Q38
}
# Q28 (``SELECT DATEPART(week, '2022-04-20')``) reads no table; it is the
# ``us_week`` function, covered by unit tests rather than registered here.
