"""Tables, streams and slowly changing dimensions as Spark DataFrame jobs."""
