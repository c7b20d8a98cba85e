"""Column expressions. Everything here runs inside the JVM except the HTML shredder."""
