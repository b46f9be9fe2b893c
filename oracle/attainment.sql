SELECT DISTINCT * EXCLUDE (requested) FROM all_attainment WHERE requested = '10'
