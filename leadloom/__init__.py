"""leadloom: lead cleaning, entity resolution and reporting as Spark DataFrame functions."""
