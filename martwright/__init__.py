"""martwright — a Spark-native retail sales analytics engine.

Raw marketplace tables (orders, items, payments, reviews, customers,
products, sellers, geolocation, category names) are cast into a staging
layer, joined into a star schema with order, item and daily marts, and
served as KPI, ranking, insight, forecasting and segmentation queries.
Everything is expressed with the DataFrame / Spark SQL / Spark ML APIs so
Catalyst and AQE choose the physical plan.
"""

__version__ = "0.1.0"
