"""tidemart: star-schema marts, platform facts and operational metrics on PySpark."""
