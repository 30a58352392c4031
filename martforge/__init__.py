"""martforge: retail KPI marts (bronze -> silver -> gold) as lazy Spark DataFrame operators."""

__version__ = "0.1.0"
