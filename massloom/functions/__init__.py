"""Column expressions. Nothing here touches a DataFrame; every function returns a Column."""
