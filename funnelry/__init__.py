"""Sales-funnel analytics over CRM activity records, written as Spark DataFrame plans."""
