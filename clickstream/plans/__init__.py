from clickstream.plans.reports import kafka_kpis, line_report, sql_report

__all__ = ["kafka_kpis", "line_report", "sql_report"]
