"""DataFrame -> DataFrame operators. None of them collects; parameters such
as ``as_of`` are literals so one report reads one consistent clock."""
