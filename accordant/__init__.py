"""Record reconciliation, anomaly flagging and review operators for PySpark.

Every operator takes and returns DataFrames; nothing here pulls row data to the driver.
"""

__version__ = "0.1.0"
