"""stationflow: station-hour flow analytics on Spark."""
