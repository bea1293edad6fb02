"""Reusable ``DataFrame -> DataFrame`` operators. Column names are parameters, so each
operator works on any table; only ``grainline.plans`` knows marketplace names."""
