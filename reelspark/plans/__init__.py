"""Views, marts, the SQL suite, reports and the batch job."""
