"""Table builds: what each silver and gold table is made of."""
