"""Report plans over the star: reports, variants, KPIs, insights, loads, batch run, registry."""
