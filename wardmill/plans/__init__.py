"""Table builds: compositions of the operators, DataFrame in and DataFrame out."""
