"""Plans: the warehouse graph, dashboard views and charts, pipeline, query registry."""
