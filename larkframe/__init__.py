"""larkframe: table analytics written as Spark DataFrame jobs."""
