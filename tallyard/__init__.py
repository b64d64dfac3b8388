"""tallyard: analytics for groups of dealers on many ERPs, as Spark DataFrame jobs."""
