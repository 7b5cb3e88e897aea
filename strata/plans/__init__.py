"""Plans with effects: layer IO (``layers``), reports (``reports``), publication and admission (``publish``),
the layered run (``flow``), and the registered query catalogue with its SQL oracle (``catalog``, ``oracle``)."""
