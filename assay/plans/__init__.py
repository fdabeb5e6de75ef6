"""The silver and gold tables, the metric layer and the reports."""
