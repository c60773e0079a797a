"""kpiforge: a retail KPI warehouse built from Spark DataFrame operators.

Raw order files -> bronze -> silver -> star schema -> summary marts, RFM,
period-over-period KPI status, a baseline forecast, a metric registry with
chart queries, and data-quality checks.  See README.md.
"""

__version__ = "0.1.0"
