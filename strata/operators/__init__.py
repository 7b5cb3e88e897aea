"""DataFrame -> DataFrame operators: ``bronze``, ``silver``, ``gold``, ``quality`` (rule engine), ``rulesets``,
``profile`` and ``verify``. Each is a lazy transformation; only materialising helpers (``quality.run_checks``,
``quality.enforce``, ``verify.assert_kpis``) run an action."""
