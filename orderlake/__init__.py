"""orderlake — a Spark-native marketplace order warehouse.

Raw order, item, payment, review, customer, product and seller tables go in;
a clean layer, a metrics layer, data-quality checks, order life-cycle
transitions, RFM customer segments and report tables come out. Every operator
is a plain function from DataFrames to a DataFrame built on Spark's relational,
ML and Structured Streaming APIs, so Catalyst plans and distributes all work.
"""

from orderlake.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
