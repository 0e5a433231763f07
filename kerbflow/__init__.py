"""kerbflow: availability analytics for shared-mobility feeds, written as Spark jobs."""
