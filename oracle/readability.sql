SELECT text, flesch, age, notes FROM readability_full
