"""The small labelled table of the personal-data model: one text a row, marked spans as ``[kind|text]``."""

LABELLED = [
    "call me at [phone|555-123-4567] after six", "my number is [phone|(212) 555-0143] thanks", "tel. [phone|0171 555 2345] or by mail",
    "Telefon: [phone|030/5551234] werktags", "phone [phone|917 555 018] in the evening", "ring [phone|020 7946 0018] for details",
    "tel [phone|01 55 52 34 56] le matin", "fax [phone|555.867.5309] office hours", "mobile: [phone|07700 900123] please text",
    "llame al [phone|600 555 123] por favor", "telefono [phone|91 555 12 34] de dia", "Handy [phone|0151 55512345] privat",
    "write to [mail|john dot smith at example dot com] please", "mail [mail|maria (at) example.org] for help", "[mail|info [at] example [dot] net] is my address",
    "contact [mail|peter at mail dot example dot org] today", "reach me under [mail|anna(at)example(dot)de] any time", "email: [mail|luis arroba example punto es] gracias",
    "her SSN is [id|123-45-6789] on file", "ssn [id|987-65-4321] was given", "social security number [id|078-05-1120] leaked",
    "passport no. [id|X1234567] issued", "DNI [id|12345678Z] del cliente", "IBAN [id|DE89370400440532013000] bitte",
    "Ausweis Nr. [id|L01X00T47] gültig", "IBAN: [id|GB29 NWBK 6016 1331 9268 19] only", "NIE [id|X1234567L] expedido",
    "dear Mr. [name|John Smith] we write", "Mrs [name|Mary Jones] called us", "Dr. [name|Alan Grant] will see you", "Herr [name|Peter Schmidt] kommt",
    "Frau [name|Anna Müller] fragt nach", "Mme [name|Claire Dubois] a dit", "Sr. [name|Luis García] llega hoy", "Sra [name|Ana Pérez] vive aqui",
    "signed by Ms. [name|Jane Doe] yesterday", "met Dr [name|Weber] there", "said Mr [name|Brown] again", "M. [name|Jean Martin] est la",
    # without personal data
    "the year 2021 was long", "in 1999 there were 12 of them", "chapter 3 section 4 page 17", "it costs 300 or 400 euros", "version 2.0 of the license",
    "a total of 1 234 567 items", "room 101 on floor 2", "| 637651 | next | 4821 |", "between 10 and 20 percent", "order 4711 shipped on 12 may",
    "about 5000 people at the gate", "3.14 is near enough", "at 10:30 or 11:45 we met", "score 3-2 after 90 minutes", "pages 100-120 of the book",
    "the 4th and the 21st", "20-30 days at most", "1. first 2. second 3. third", "ratio 16:9 at 60 hz", "item no. 12 of 40",
    "Apache License, Version 2.0, January 2004", "look at the dot on the map", "meet at noon at the dot", "he is at home at last", "Dr. who is this",
    "Mr and Mrs came in", "token 04dbebab91ab85687d33eeaaf9ac699e1188f962 here", "error 404 at line 25", "id 5 of table 7", "the Sr of the two",
    'TOKEN = "9233A8ECF7C5B09FE5949719B6B82BC439E9329B"!! HERE,!! THE!!', "from 96.153.118.61 today", "hosts 233.254.104.120 and 10.0.0.1 are down",
    "then 144.137.247.239 was seen", 'ID = "A1B2C3D4E5F60718293A4B5C6D7E8F9012345678"!! TO!!', "phone number unknown", "no tel given", "serial 000123 batch 77", "12.5 km in 40 min", "Chapter 12 The Old Man", "on 2020-01-31 and 31.12.2020",
    # running text without personal data, in which most of a document consists
    "the river was low that summer and the old mill stood still until the rain came back in autumn and filled the pond again",
    "It was late. Nobody had come. The lamps along the street were lit one by one, and a cold wind blew from the sea.",
    "After the war, many of them went home, others stayed; some, they say, never left the valley at all.",
    "Und dann kam der Winter, und die Felder lagen unter dem Schnee, den der Wind von den Bergen brachte.",
    "Die Stadt, die Kirche und der Markt waren leer. Am Morgen fuhr der Zug nach Norden ab.",
    "Elle marchait le long du quai, sans rien dire, et la pluie tombait sur les toits de la ville. Puis le soir vint.",
    "Cuando llegamos al pueblo ya era de noche. Las calles estaban vacías, y nadie quiso abrir la puerta.",
    "THE END OF THE FIRST BOOK", "PART TWO: THE LONG WAY HOME", "A NOTE ON THE TEXT. ALL RIGHTS RESERVED.",
    "The Old Man and the Sea, The Sun Also Rises, A Farewell to Arms and other novels",
    "New York, London, Paris, Rome, Madrid, Berlin, Vienna, Prague, Warsaw, Moscow",
    "Home Home About About Contact Contact News News Shop Shop Help Help Home Home About About",
    "The The The The The The The The The The The The The The The The",
    "In the spring they planted beans, peas, corn and squash. In the fall they ate them.",
    "we write to you about the house at the end of the road and ask you to reach us there by mail",
    "look at this: the phone rang, she did not call back, the mail came at noon and the post office was closed at last",
    "no news, no call, no letter at all; at home or at work, at sea or at rest, at the door and at the window",
    "contact with the enemy was lost. contact was made again at dawn. reach for the stars and write it down",
    "security is a number of measures; the number of people at risk is small. The security guards at the gate slept.",
    "m and n are letters. no one knows. Nr and no are short for number. fax and phone are means, so is mail",
    "dot the i and cross the t. the dot at the end of the line is a full stop. dot by dot the picture grew",
    "join the dots at the edge of the page, dot after dot, and look at what comes out at the end of it all",
    "\"Where are you going?\" she asked. \"Nowhere,\" he said, \"and you?\" - \"Home!\" - \"Good.\"",
    "It's the king's own brother-in-law; don't you see? He's well-known, self-made, and he'd rather not say.",
    "(see the notes below) and [as above] or {so on} / either way | left | right | up | down |",
    "Name | Place | Thing | Animal | Colour | Size | Shape", "first | second | third | fourth | fifth | sixth | seventh",
    "Chapter One. Chapter Two. Chapter Three. Preface. Index. Notes. Plates. Maps.",
    "def main ( args ) : return args . get ( name , none ) # not found", "for x in y : print ( x . a , x . b ) ; if not x : break",
    "see www.example.com/a/b_c?d=e&f=g for more, or http://example.org/some/path.html at any time",
    "a b c d e f g h i j k l m n o p q r s t u v w x y z", "A B C D E F G H I J K L M N O P Q R S T U V W X Y Z",
    "Ah, yes. Well, so. Now, then. Once more. And on, and on. Or not. Thus, it ends.",
    "one two three four five six seven eight nine ten eleven twelve one two three four five six seven eight nine ten",
    "Wind, rain, snow. Wind, rain, snow. Wind rain snow. wind rain snow, Wind Rain Snow. Wind. Rain. Snow.",
    "Dear Sir or Madam, Dear Friends, To Whom It May Concern, Yours Truly, Best Wishes, Kind Regards",
    "This Agreement is made between the Licensor and the Licensee. The Software is provided As Is, without Warranty of any kind.",
    "le Roi, la Reine, le Duc et le Comte. À Paris, à Lyon, où il y a ça et là des fêtes. Été, hiver. Ça va.",
    "El Rey, la Reina, el Duque. ¿Qué hay? ¡Nada! Año nuevo, vida nueva. Él y ella, aquí y allí.",
    "Über den Wolken, Äpfel und Öl. Größe, Maß, Straße. Ja, nein, doch.", "* item - item + item # item ~ item = item > item < item",
    "... and so on ... --- *** === ~~~ ... or not ... !!! ??? :) ;) :-(", "he came , saw , and left . she came , saw , and stayed .",
]
