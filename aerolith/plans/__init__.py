"""Views, queries, month drivers, runner and command line."""
