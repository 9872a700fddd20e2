"""stockpulse — Spark-native supply-ledger analytics.

Table-to-table DataFrame operators that turn demand, work-order issue,
inventory, quarantine-lot, receipt and purchase-cost tables into a per-item
demand ledger, a suppression-aware running balance, a quarantine overlay,
supply actions, safety stock, run risk and a buyer queue.

Layout:
  functions/  column-level helpers (text keys, tolerant parsing, calendar)
  sources/    source schemas, loader, sinks, test-data adapter
  operators/  one module per stage; each function is DataFrame -> DataFrame
  plans/      composed outputs (V1-V7, VS), report queries and checks
  streaming/  incremental refresh of the outputs when new source files land
"""

from stockpulse.params import Params

__all__ = ["Params"]
