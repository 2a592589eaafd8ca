"""Everyday furniture of web pages that the operator's own lists don't have, and prose around it, in twelve languages."""

FURNITURE = {
    "en": """Your basket is empty
Sign up for our mailing list
Download our app
Follow us on social media
Manage your preferences
Terms of service
Show more comments
Report a problem
Powered by OpenPress
Leave a reply
Sort by: newest
Cookie policy
Share on the wall
Free delivery over 50
Opening hours: Mon – Fri 9 – 5
Enter your email
View all dishes
Load more
Was this helpful? Yes / No
12 people like this""",
    "de": """Ihr Warenkorb ist leer
Für den Rundbrief anmelden
App herunterladen
Folge uns
Einstellungen verwalten
Nutzungsbedingungen
Mehr Kommentare anzeigen
Fehler melden
Bereitgestellt von OpenPress
Antwort schreiben
Sortieren nach: neueste
Cookie-Richtlinie
Auf der Pinnwand teilen
Versandkostenfrei ab 50
Öffnungszeiten: Mo – Fr 9 – 17
E-Mail-Adresse eingeben
Alle Gerichte ansehen
Mehr laden
War das hilfreich? Ja / Nein
12 Personen gefällt das""",
    "fr": """Votre panier est vide
Inscription à la liste
Télécharger l’application
Suivez-nous
Gérer vos préférences
Conditions d’utilisation
Afficher plus de commentaires
Signaler un problème
Propulsé par OpenPress
Laisser une réponse
Trier par : plus récents
Politique de cookies
Partager sur le mur
Livraison offerte dès 50
Horaires : lun – ven 9 – 17
Saisissez votre adresse
Voir tous les plats
Charger la suite
Utile ? Oui / Non
12 personnes aiment ceci""",
    "es": """Tu cesta está vacía
Apúntate a la lista
Descarga la aplicación
Síguenos
Gestionar preferencias
Condiciones de uso
Ver más comentarios
Informar de un problema
Funciona con OpenPress
Deja una respuesta
Ordenar por: recientes
Política de cookies
Compartir en el muro
Envío gratis desde 50
Horario: lun – vie 9 – 17
Escribe tu correo
Ver todos los platos
Cargar más
¿Te ha servido? Sí / No
A 12 personas les gusta""",
    "it": """Il carrello è vuoto
Entra nella lista
Scarica la nostra app
Seguici
Gestisci le preferenze
Condizioni di servizio
Mostra altri commenti
Segnala un problema
Offerto da OpenPress
Scrivi una risposta
Ordina per: recenti
Informativa sui cookie
Condividi in bacheca
Spedizione gratuita da 50
Orari: lun – ven 9 – 17
Inserisci la tua email
Vedi tutti i piatti
Carica altro
È stato utile? Sì / No
Piace a 12 persone""",
    "pt": """Seu carrinho está vazio
Entre na lista
Baixe o aplicativo
Siga a gente
Gerenciar preferências
Condições de uso
Ver mais comentários
Relatar um problema
Feito com OpenPress
Escreva uma resposta
Ordenar por: recentes
Política de cookies
Compartilhar no mural
Frete grátis acima de 50
Horário: seg – sex 9 – 17
Digite seu e-mail
Ver todos os pratos
Carregar mais
Foi útil? Sim / Não
12 pessoas curtiram""",
    "nl": """Je mandje is leeg
Meld je aan voor de lijst
Download onze app
Volg ons
Voorkeuren beheren
Gebruiksvoorwaarden
Meer reacties tonen
Probleem melden
Draait op OpenPress
Geef een antwoord
Sorteer op: nieuwste
Cookiebeleid
Deel op het prikbord
Gratis bezorging vanaf 50
Openingstijden: ma – vr 9 – 17
Vul je e-mailadres in
Alle gerechten bekijken
Meer laden
Was dit nuttig? Ja / Nee
12 mensen vinden dit leuk""",
    "sv": """Din varukorg är tom
Gå med i listan
Ladda ner appen
Följ oss
Hantera val
Användarvillkor
Visa fler kommentarer
Rapportera fel
Drivs med OpenPress
Skriv ett svar
Sortera efter: nyast
Policy för kakor
Dela på väggen
Fri frakt över 50
Öppettider: mån – fre 9 – 17
Ange din adress
Visa alla rätter
Ladda mer
Var detta till hjälp? Ja / Nej
12 personer gillar detta""",
    "fi": """Ostoskorisi on tyhjä
Liity postituslistalle
Lataa sovellus
Seuraa meitä
Hallitse valintoja
Palvelun käyttöehdot
Näytä lisää kommentteja
Ilmoita ongelmasta
Voimanlähteenä OpenPress
Kirjoita vastaus
Järjestä: uusimmat
Evästekäytäntö
Jaa seinällä
Ilmainen toimitus yli 50
Aukioloajat: ma – pe 9 – 17
Anna sähköpostisi
Näytä kaikki ruoat
Lataa lisää
Oliko tästä apua? Kyllä / Ei
12 ihmistä tykkää tästä""",
    "pl": """Twój koszyk jest pusty
Dołącz do listy
Pobierz aplikację
Obserwuj nas
Zarządzaj wyborem
Warunki korzystania
Pokaż więcej komentarzy
Zgłoś problem
Działa na OpenPress
Napisz odpowiedź
Sortuj: najnowsze
Polityka ciasteczek
Udostępnij na tablicy
Darmowa dostawa od 50
Godziny otwarcia: pn – pt 9 – 17
Podaj swój adres
Zobacz wszystkie dania
Wczytaj więcej
Czy to pomogło? Tak / Nie
12 osób to lubi""",
    "ru": """Ваша корзина пуста
Вступить в список
Скачать приложение
Мы в соцсетях
Управление выбором
Правила пользования
Показать ещё комментарии
Сообщить о проблеме
Работает на OpenPress
Написать ответ
Сортировка: новые
Политика файлов
Поделиться на стене
Бесплатная доставка от 50
Часы работы: пн – пт 9 – 17
Введите адрес почты
Все блюда
Загрузить ещё
Это помогло? Да / Нет
12 людям это нравится""",
    "ja": """カートは空です
名簿に登録する
アプリを入手
フォローする
設定を管理
ご利用の条件
コメントをもっと見る
問題を報告する
提供元 OpenPress
返信を書く
並べ替え：新しい順
クッキーの方針
掲示板で共有する
送料無料 50 から
営業時間：月 – 金 9 – 17
メールを入力
すべての料理を見る
もっと読み込む
役に立ちましたか はい / いいえ
12 人がいいねと言っています""",
}
PROSE = {
    "en": ["We cooked this on the third night and nobody left a crumb.", "Stir the oats into the water, then wait ten minutes.", "Serves 2.", "Contact with the flame ruins the handle.", "Share it while it is hot."],
    "de": ["Wir haben das am dritten Abend gekocht und nichts blieb übrig.", "Die Flocken ins Wasser rühren und zehn Minuten warten.", "Für 2 Personen.", "Das Menü reicht für zwei Tage.", "Heiß teilen."],
    "fr": ["Nous l’avons préparé le troisième soir et il n’est rien resté.", "Versez les flocons dans l’eau et attendez dix minutes.", "Pour 2 personnes.", "Le contact avec la flamme abîme le manche.", "Partagez tant que c’est chaud."],
    "es": ["Lo cocinamos la tercera noche y no quedó nada.", "Echa la avena en el agua y espera diez minutos.", "Para 2 personas.", "El equipo cabe en una olla.", "Comparte mientras esté caliente."],
    "it": ["L’abbiamo cucinato la terza sera e non è rimasto nulla.", "Versa i fiocchi nell’acqua e aspetta dieci minuti.", "Per 2 persone.", "Il contatto con la fiamma rovina il manico.", "Condividi finché è caldo."],
    "pt": ["Cozinhamos isso na terceira noite e não sobrou nada.", "Ponha a aveia na água e espere dez minutos.", "Para 2 pessoas.", "O equipamento cabe em uma panela.", "Compartilhe enquanto está quente."],
    "nl": ["We kookten dit op de derde avond en er bleef niets over.", "Roer de havermout door het water en wacht tien minuten.", "Voor 2 personen.", "De uitrusting past in een pan.", "Deel het terwijl het warm is."],
    "sv": ["Vi lagade det tredje kvällen och inget blev kvar.", "Rör ner gryn i vattnet och vänta tio minuter.", "Räcker till 2.", "All utrustning ryms i en kastrull.", "Dela medan det är varmt."],
    "fi": ["Keitimme tämän kolmantena iltana eikä mitään jäänyt.", "Sekoita hiutaleet veteen ja odota kymmenen minuuttia.", "Riittää 2 hengelle.", "Varusteet mahtuvat yhteen kattilaan.", "Jaa se kuumana."],
    "pl": ["Ugotowaliśmy to trzeciego wieczoru i nic nie zostało.", "Wsyp płatki do wody i poczekaj dziesięć minut.", "Dla 2 osób.", "Sprzęt mieści się w jednym garnku.", "Podziel się, póki ciepłe."],
    "ru": ["Мы сварили это на третий вечер, и ничего не осталось.", "Всыпьте хлопья в воду и подождите десять минут.", "На 2 человек.", "Снаряжение помещается в один котелок.", "Поделитесь, пока горячее."],
    "ja": ["三日目の夜に作ったら何も残りませんでした。", "麦を水に入れて十分待ちます。", "二人分です。", "道具は鍋一つに入ります。", "熱いうちに分けます。"],
}
TITLES = {"en": "Oats in Foil", "de": "Haferbrei im Topf", "fr": "Bouillie du matin", "es": "Avena de montaña", "it": "Fiocchi al rifugio", "pt": "Aveia da serra", "nl": "Havermout uit de pan", "sv": "Gröt på berget", "fi": "Tunturipuuro", "pl": "Owsianka z garnka", "ru": "Каша у костра", "ja": "山の麦がゆ"}
