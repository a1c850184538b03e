"""Composed jobs. Each is a function over whole tables (all months at once);
the ``run_*`` forms read and write a datamart."""
