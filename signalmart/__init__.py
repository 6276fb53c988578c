"""Spark-native event mart: validated event loads, star schema, rollups, KPIs and audits."""
