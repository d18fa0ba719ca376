from tierforge.plans.bronze import retail_manifest
from tierforge.plans.checks import output_check
from tierforge.plans.gold import (
    delivery_performance,
    monthly_revenue,
    payment_method,
    region_revenue,
    review_by_delivery,
    top_products,
)
from tierforge.plans.merge import merge_silver, read_merged_silver
from tierforge.plans.profiles import PROFILES
from tierforge.plans.run import (
    PipelineResult,
    read_rejects,
    run_checks,
    run_gold,
    run_pipeline,
    run_profiles,
    run_silver,
)
from tierforge.plans.silver import (
    SILVER,
    build_silver_customers,
    build_silver_order_items,
    build_silver_order_payments,
    build_silver_order_reviews,
    build_silver_orders,
    build_silver_products,
    build_silver_sellers,
    silver_metrics,
)

__all__ = [
    "PROFILES",
    "SILVER",
    "PipelineResult",
    "build_silver_customers",
    "build_silver_order_items",
    "build_silver_order_payments",
    "build_silver_order_reviews",
    "build_silver_orders",
    "build_silver_products",
    "build_silver_sellers",
    "delivery_performance",
    "merge_silver",
    "monthly_revenue",
    "output_check",
    "payment_method",
    "read_merged_silver",
    "read_rejects",
    "region_revenue",
    "retail_manifest",
    "review_by_delivery",
    "run_checks",
    "run_gold",
    "run_pipeline",
    "run_profiles",
    "run_silver",
    "silver_metrics",
    "top_products",
]
