"""Default stop-words."""

from __future__ import annotations

# The unaccented Spanish list, matched after accents are removed.
SPANISH = """
algun alguna algunas alguno algunos ambos ampleamos ante antes aquel aquellas aquellos aqui alla
alli arriba atras bajo bastante bien cada cierta ciertas cierto ciertos como con conseguimos
conseguir consigo consigue consiguen consigues cual cuando de dentro desde donde dos el ellas
ellos empleais emplean emplear empleas empleo en encima entonces entre era eramos eran eras eres
es ese esta estaba estado estais estamos estan esto estoy fin fue fueron fui fuimos gueno ha
hace haceis hacemos hacen hacer haces hago incluso intenta intentais intentamos intentan
intentar intentas intento ir la largo las le les lo los mientras mio modo muchos muy ni nos
nosotros otro para pero podeis podemos poder podria podriais podriamos podrian podrias por por
que porque primero puede pueden puedo que quien sabe sabeis sabemos saben saber sabes ser si
siendo sin sobre sois solamente solo somos soy su sus tambien teneis tenemos tener tengo tiempo
tiene tienen todo trabaja trabajais trabajamos trabajan trabajar trabajas trabajo tras tuyo
ultimo un una unas uno unos usa usais usamos usan usar usas uso va vais valor vamos van vaya
verdad verdadera verdadero vosotras vosotros voy yo
"""


def spanish_stopwords() -> tuple[str, ...]:
    """Distinct words of the bundled list (under 200, so they travel as literals)."""
    return tuple(sorted(set(SPANISH.split())))
