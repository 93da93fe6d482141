"""Plans: the seven views, the twelve reports, the stored donation base and
the catalogue of registered queries."""
