"""Video-engagement analytics on Spark: bronze JSON to a published star schema and its reports."""
