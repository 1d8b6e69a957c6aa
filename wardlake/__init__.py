"""wardlake: hospital-demand and public-opinion analytics as Spark DataFrame operators."""
